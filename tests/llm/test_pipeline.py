"""Stages of the pipeline against brute force, and their results for odd rows."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from feedlake.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages_on_given_documents(spark):
    import collections
    from test_operators import _brute_near, _brute_repeats
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), "stage")
        seen.append(name)
        before = {r.doc_id: r for r in docs.collect()}
        after = {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before)
        if name != "mixing":
            assert out.schema == docs.schema and out.count() == len(after)
        if name == "near_dedup":
            want = _brute_near([(d, r.text) for d, r in before.items()])
            assert set(after) == {d for d, _, _, kept in want if kept}
        if name == "suffix_array_dedup":
            removed = {d: n for d, _, n, _, _ in _brute_repeats([(d, r.text) for d, r in before.items()])}
            for d, r in before.items():
                if not removed[d]:
                    assert after[d] == r
                elif d in after:
                    # a cut at half a character loses that character
                    size = len(r.text.encode()) - removed[d]
                    assert size - 60 <= len(after[d].text.encode()) <= size and after[d].n_chars == len(after[d].text)
                else:
                    assert removed[d] >= len(r.text.encode()) - 60
        if name == "decontamination":
            grams = collections.defaultdict(set)
            for item in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
                words = item.text.lower().split()
                for i in range(len(words) - 4):
                    grams[tuple(words[i:i + 5])].add((item.item_id, len(words) - 4))
            for d, r in before.items():
                words, hits = r.text.lower().split(), collections.Counter()
                for i in range(len(words) - 4):
                    hits.update(grams.get(tuple(words[i:i + 5]), ()))
                share = max((n / size for (_, size), n in hits.items()), default=0)
                assert (d in after) == (share < 0.5), (d, share)
        docs = out
    assert seen == ["language_id", "near_dedup", "suffix_array_dedup", "decontamination", "mixing"]


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages_on_odd_rows(spark, odd, rows):
    docs = odd if rows == "odd" else odd.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), "stage")
        assert out.columns[:len(docs.columns)] == docs.columns
        if rows == "none":
            assert out.count() == 0
        assert out.where(F.col("doc_id") == 2).count() == 0 or name != "language_id"


def test_entry_registers_every_query():
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
