"""The training-data pipeline: five stages over ``documents``, each written as Parquet and read again.

Language ID drops rows without a known language, near-dedup keeps one document of each
group, the suffix-array stage cuts byte strings that a smaller document has (and drops
documents of which no more than white space is left), decontamination drops documents
that hold benchmark items, and mixing repeats the rest to the sources' target weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlake.llm import decontaminate, langid, mixing, near_dedup, repeats
from feedlake.llm.common import stored, table

#: Score below which a single language counts as unknown.
LEAST_SCORE = 0.3


#: Rows of an Arrow batch in the stages: whole texts of some kilobytes each, on the way to a worker and back.
ARROW_ROWS = 1000


def _bounded(spark: SparkSession) -> None:
    """Smaller Arrow batches for what follows in this session: the stages' workers and buffers share an executor."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, ARROW_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is known, all columns as they are.

    Texts that are null, empty or without letters have no language and go. Rows are judged one by one, so
    repeated rows stay or go together; null ids and sources do not matter. Languages are learned from the rows
    with a text and a ``lang``; without any, nothing is known and all rows go. An empty table gives none. Extra
    columns are carried, whatever their names.
    """
    _bounded(spark)
    langs, model = langid.fit(docs)
    return langid.identified(docs, langs, model, LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id, all columns as they are.

    Texts that are null, empty or blank are in no group and stay. Rows with a null id, or one that several rows
    have, count as if their ids were above all others, each its own: of repeated rows one stays, of a group
    without any other id one. An empty table gives none. Extra columns are carried, whatever their names.
    """
    _bounded(spark)
    return near_dedup.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows without the 50-byte strings that a smaller document has; rows of which no more than white space is
    left go.

    Rows that lose nothing stay as they are, null and empty texts too; others get the number of characters left
    as ``n_chars``. A cut inside a character drops that character. A null id is above all others; rows with one
    id take nothing from each other. An empty table gives none. Extra columns are carried, whatever their names.
    """
    _bounded(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # the other columns travel as one, so that their names meet no column of the report
    packed = docs.select("doc_id", "text", F.struct(F.lit(True).alias("_"), *others).alias("others"))
    cut = repeats.remove_repeats(packed, columns=["others"], decode=True)
    whole = F.col("n_removed") == 0
    kept = cut.where(whole | (F.trim(F.regexp_replace("kept", r"\s+", " ")) != ""))

    def column(name: str):
        if name == "text":
            return F.col("kept")
        if name == "n_chars":
            return F.when(whole, F.col("others.n_chars")).otherwise(F.length("kept"))
        return F.col("doc_id") if name == "doc_id" else F.col("others").getField(name)
    return kept.select(*[column(c).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of ``benchmark``, all columns as they are.

    Null, empty and wordless texts and items match nothing, so such rows stay. Rows are judged one by one, so
    repeated rows stay or go together; null ids do not matter. An empty benchmark takes nothing away, an empty
    table gives none. Extra columns are carried, whatever their names.
    """
    _bounded(spark)
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows repeated to the sources' target weights, in shuffled order: all columns, then ``copy_no`` and
    ``shuffle_key`` (columns of these names are replaced).

    Texts are carried, null and empty ones too. Null sources form one source; rows with one id, or without any,
    get the same number of copies, so repeated rows are repeated alike. An empty table gives none.
    """
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("decontamination", decontamination),
    ("mixing", target_weights),
]

#: Language ID and the latent space have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
