"""Operators against brute force, and their results for odd rows."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import components, decontaminate, langid, mixing, near_dedup, quality, repeats, token_counts, topk, toxicity, warc
from feedlake.llm.suffix_array import permuted_common_prefixes, suffix_array

SF = "/root/testdata/sf0.001"


def ids(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# 1 token counts

@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.piece_values(token_counts.read_vocabulary())


def test_trie_equals_plain_recurrence(vocabulary):
    rng = random.Random(1)
    tokens = {"".join(rng.choices("abcé theing 日", k=rng.randint(1, 45))) for _ in range(800)}
    counts = token_counts.Counter(vocabulary)
    counts.learn(set(list(tokens)[:300]))
    counts.learn(tokens - counts.keys())
    longest = max(map(len, vocabulary))
    assert {t: counts[t] for t in tokens} == {t: token_counts.segment(t.encode(), vocabulary, longest) for t in tokens}


def test_long_words_stay_in_the_trie(vocabulary, monkeypatch):
    rng = random.Random(3)
    stem = "".join(rng.choices("abcdethéing日", k=90))
    tokens = {stem[:n] + "".join(rng.choices("ething", k=rng.randint(0, 60))) for n in range(5, 90) for _ in range(4)} | {stem, "e" * 3000}
    longest = max(map(len, vocabulary))
    want = {t: token_counts.segment(t.encode(), vocabulary, longest) for t in tokens}
    counts = token_counts.Counter(vocabulary)
    monkeypatch.setattr(token_counts, "segment", None)  # no word is scored by itself
    looked = collections.Counter()

    class Looked(dict):
        def get(self, piece):
            looked[piece] += 1
            return dict.get(self, piece)
    counts.pieces = Looked(vocabulary)
    counts.learn(tokens)
    assert counts == want
    deep = {t.encode()[:n] for t in tokens for n in range(token_counts.WIDTH + 1, len(t.encode()) + 1)}
    assert sum(looked.values()) <= longest * len(deep)  # one node a distinct prefix


def test_a_hash_without_the_bytes_is_no_piece(vocabulary, monkeypatch):
    plain = token_counts.Counter._hash
    monkeypatch.setattr(token_counts.Counter, "_hash", staticmethod(lambda rows: plain(rows % 64)))  # bytes 64 apart clash
    counts = token_counts.Counter(vocabulary)
    tokens = {"the", "that", "4(%", "THE", "\u0134\u0128"}
    counts.learn(tokens)
    longest = max(map(len, vocabulary))
    assert counts == {t: token_counts.segment(t.encode(), vocabulary, longest) for t in tokens}


def test_token_counts_equal_brute_force(spark, vocabulary):
    import regex
    from feedlake.llm.queries import op1_token_counts
    longest, known = max(map(len, vocabulary)), {}
    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in op1_token_counts(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        found = regex.findall(token_counts.PRE_TOKEN, text or "")
        for t in set(found) - known.keys():
            known[t] = token_counts.segment(t.encode(), vocabulary, longest)
        assert got[doc_id] == (len(found), sum(known[t] for t in found))


def test_ascii_pattern_cuts_alike():
    import re
    import regex
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choices("ab1'st ll\n\t .,_-\x1c\x0b", k=40))
        assert re.findall(token_counts.ASCII_PRE_TOKEN, text, re.ASCII) == regex.findall(token_counts.PRE_TOKEN, text)


def test_token_counts_odd_rows(odd):
    got = token_counts.count_tokens(odd)
    assert got.count() == 10
    rows = {r.doc_id: r for r in got.collect()}
    assert (rows[2].n_tokens, rows[3].n_tokens) == (0, 0)
    assert rows[7].n_tokens >= 40_000 and rows[8].n_pretokens == 3
    assert token_counts.count_tokens(odd.limit(0)).count() == 0


# 3 language ID

TEXTS = {"en": "the house and the garden with that which have been there this thing ",
         "fr": "une maison avec les jardins que vous avez dans cette chose pour nous ",
         "de": "das haus und der garten mit dem sich nicht werden eine sache "}


def _learned(docs):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        lang = ["en", "fr", "de"][i % 3]
        words = TEXTS[lang].split()
        rows.append((i, " ".join(rng.choices(words, k=60)), lang))
    return langid.fit(docs(rows))


def test_language_mixture(docs):
    langs, model = _learned(docs)
    assert langs == ["de", "en", "fr"]
    rng = random.Random(4)
    en, fr = (rng.choices(TEXTS[x].split(), k=n) for x, n in (("en", 140), ("fr", 60)))
    got = langid.identify(docs([(1, " ".join(en)), (2, " ".join(en + fr)), (3, "Größe 12")]), langs, model)
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[1].langs == ["en"] and rows[1].score == pytest.approx(1, abs=1e-6)
    assert rows[2].langs == ["en", "fr"] and rows[2].lang_pred == "en" and 0.6 < rows[2].score < 0.8
    assert rows[3].lang_pred in langs


def test_language_sets_are_the_penalised_optimum(docs):
    import itertools
    langs, model = _learned(docs)
    rng = random.Random(5)
    texts = [" ".join(rng.choices(TEXTS["en"].split(), k=50) + rng.choices(TEXTS["fr"].split(), k=n)) for n in (0, 1, 4, 20)]
    shares, _ = langid.infer(texts, model)
    for text, share in zip(texts, shares):
        _, gram = langid.trigrams([text])
        like = model[gram].astype(float)
        worth = {}
        for size in (1, 2, 3):
            for among in itertools.combinations(range(3), size):
                p = np.zeros(3)
                p[list(among)] = 1 / size
                for _ in range(400):
                    part = like * p
                    p = (part / part.sum(axis=1, keepdims=True)).mean(axis=0)
                worth[among] = np.log(like @ p).sum() - (size - 1) * langid.PENALTY * np.log(len(gram) + 1)
        assert tuple(np.flatnonzero(share > 0)) == max(worth, key=worth.get)


def test_language_odd_rows(docs, odd):
    langs, model = _learned(docs)
    rows = langid.identify(odd, langs, model).collect()
    assert len(rows) == 10
    unknown = {(r.doc_id, r.score) for r in rows if r.lang_pred == "und"}
    assert unknown == {(2, 0.0), (3, 0.0), (4, 0.0), (None, 0.0), (8, 0.0)}
    kept = langid.identified(odd, langs, model, 0.3)
    assert kept.columns == odd.columns and kept.where("doc_id = 1").count() == 2
    none, empty = langid.fit(odd.limit(0))
    assert {r.lang_pred for r in langid.identify(odd, none, empty).collect()} == {"und"}
    assert langid.identify(odd.limit(0), langs, model).count() == 0


def test_an_even_split_over_four_languages_is_known(docs):
    rng = random.Random(24)
    words = {x: ["".join(rng.choices(letters, k=rng.randint(4, 8))) for _ in range(60)]
             for x, letters in (("aa", "abcdef"), ("bb", "ghijkl"), ("cc", "mnopqr"), ("dd", "stuvwx"))}
    langs, model = langid.fit(docs([(i, " ".join(rng.choices(words[x], k=80)), x) for i, x in enumerate([*words] * 20)]))
    # as many trigrams of each language, so that no share is much above a quarter
    even = docs([(1, " ".join(" ".join(rng.choices([w for w in words[x] if len(w) == 6], k=60)) for x in words)), (2, "12 !")])
    row = next(r for r in langid.identify(even, langs, model).collect() if r.doc_id == 1)
    assert row.langs == langs and row.score < 0.3
    assert [r.doc_id for r in langid.identified(even, langs, model, 0.3).collect()] == [1]


def test_language_accuracy_on_held_out_documents(spark):
    from feedlake.llm.queries import op3_language_id
    got = op3_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


# 4 suffix-array dedup

def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for trial in range(200):
        k = int(rng.integers(1, 6))
        body = rng.integers(1, k + 1, int(rng.integers(1, 160)))
        if trial % 3 == 0:
            body = np.tile(body[:4], 30)
        s = np.append(body, 0)
        values = s.tolist()
        sa = suffix_array(s, k + 1)
        assert sa.tolist() == sorted(range(len(values)), key=lambda i: values[i:])
        data = (body + 96).astype(np.uint8)
        prefix, raw = permuted_common_prefixes(data, sa[1:], 20), data.tobytes()
        for a, b in zip(sa[1:-1], sa[2:]):
            same = next((i for i in range(20) if raw[a + i:a + i + 1] != raw[b + i:b + i + 1] or a + i >= len(raw) or b + i >= len(raw)), 20)
            assert prefix[b] == same


@pytest.mark.parametrize("full", [0, 1, 32, 1 << 30])
def test_every_level_of_the_recursion_is_induced(monkeypatch, full):
    import feedlake.llm.suffix_array as module
    monkeypatch.setattr(module, "FULL", full)   # buckets at a time, suffix by suffix, or by the buckets' sizes
    rng, levels, induce = np.random.default_rng(15), [], module._Text.induce
    monkeypatch.setattr(module._Text, "induce", lambda self, lms: levels.append((len(self.s), self.size)) or induce(self, lms))
    word = rng.integers(1, 200, 300).tolist()
    texts = [rng.integers(1, 6, 600).tolist(), rng.integers(1, 250, 900).tolist() + word + [7] * 40 + word, [1, 2] * 200 + [1] * 90 + [2, 1] * 100]
    for values in texts:
        levels.clear()
        s = np.array(values + [0], np.int16)
        values = s.tolist()
        assert suffix_array(s, 256).tolist() == sorted(range(len(values)), key=lambda i: values[i:])
        # two inductions a level, and a level below for names that repeat
        assert len(levels) >= 2 and len(levels) % 2 == 0
    levels.clear()
    repeated = np.array((rng.integers(1, 250, 4000).tolist()) * 2 + [0], np.int16)
    suffix_array(repeated, 256)
    assert len({n for n, _ in levels}) >= 2 and max(size for n, size in levels[1:]) > 500   # names of a deeper level


def test_fragments_alone_with_their_anchor_are_not_sorted(monkeypatch):
    rng = random.Random(16)
    text = bytes(rng.choices(range(97, 123), k=3000))
    packs_ = [repeats.Pack(__import__("pyarrow").RecordBatch.from_pydict({"doc_id": [i], "text": [t.decode()]}))
              for i, t in enumerate((text, text[500:900] + b"other " * 30, b"xyz" + text[1000:1060], text))]
    found = [(p.bytes[b:b + w + repeats.LENGTH - 1], int(a)) for p in packs_ for b, w, a, _ in zip(*p.fragments())]
    texts = sorted({t for t, _ in found})
    anchor = dict(found)
    several = collections.Counter(anchor[t] for t in texts)
    longest = {a: max(len(t) for t in texts if anchor[t] == a) for a in several}
    met = repeats.meeting(texts)
    assert met.tolist() == [several[anchor[t]] > 1 and longest[anchor[t]] > repeats.LENGTH for t in texts] and 0 < met.sum() < len(texts) / 4


def _brute_repeats(rows):
    key = lambda d: 2**63 if d is None else d
    first, out = {}, []
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            first[b[i:i + 50]] = min(key(d), first.get(b[i:i + 50], 2**64))
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < key(d):
                gone[i:i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 3000}, {"shard_bytes": 3000, "hot": 0}])
def test_repeats_equal_brute_force(docs, options, monkeypatch):
    monkeypatch.setattr(repeats, "PACK", 1 << 22 if not options else 4000)
    rng = random.Random(6)
    passages = ["".join(rng.choices("abcd éß", k=n)) for n in (30, 49, 50, 51, 80, 200, 1500)]
    rows = [(i if i % 7 else i - 7, "".join(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices("abcdxyz ", k=rng.randint(1, 120)))
                                            for _ in range(rng.randint(0, 8)))) for i in range(60)]
    rows += [(100, "ab" * 300), (101, "ba" * 300), (102, None), (103, ""), (None, "ab" * 100), (None, passages[4]), (105, "\x00" * 120), (104, "\x00" * 60)]
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert ids(repeats.remove_repeats(docs(rows), **options), *columns) == _brute_repeats(rows)


def test_repeats_on_given_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert ids(repeats.remove_repeats(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == _brute_repeats(rows)


def test_repeats_odd_rows(odd, odd_docs):
    assert ids(repeats.remove_repeats(odd), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == _brute_repeats([r[:2] for r in odd_docs])
    assert repeats.remove_repeats(odd.limit(0)).count() == 0
    cut = repeats.remove_repeats(odd.select("doc_id", "text", "lang"), columns=["lang"], decode=True)
    assert cut.where("kept IS NULL").count() == 2


# 5 quality

def test_discriminant_equals_densities(spark):
    rng = np.random.default_rng(7)
    p = len(quality.FEATURES)
    x = np.concatenate([rng.normal(0, 1, (300, p)), rng.normal(0.7, 2, (200, p))])
    y = [0] * 300 + [1] * 200
    df = spark.createDataFrame([(i, [float(v) for v in row], c) for i, (row, c) in enumerate(zip(x, y))], "doc_id long, x array<double>, q int")
    model = quality.fit(df, "q", pooled=0.0, identity=0.0)
    logs = []
    for c in (0, 1):
        own = x[np.array(y) == c]
        cov = np.cov(own.T, bias=True)
        gap = x - own.mean(axis=0)
        logs.append(np.log(len(own)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ni,ij,nj->n", gap, np.linalg.inv(cov), gap))
    want = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
    assert np.allclose(model.score(x), want)
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    assert np.allclose([got[i] for i in range(500)], want)


def test_quality_odd_rows(odd):
    rows = quality.features(odd)
    assert rows.count() == 10 and rows.where("exists(x, v -> isnan(v) OR v IS NULL)").count() == 0
    labels = odd.select("doc_id").distinct().where("doc_id IS NOT NULL").withColumn("q", (F.col("doc_id") % 2).cast("int"))
    model = quality.fit(rows.join(labels, "doc_id"), "q")
    scores = [r.score for r in quality.score(rows, model).collect()]
    assert len(scores) == 10 and all(0 <= s <= 1 for s in scores)
    assert quality.fit(rows.join(labels.where("q = 1"), "doc_id"), "q") is None
    assert quality.fit(rows.join(labels, "doc_id").limit(0), "q") is None
    assert {r.score for r in quality.score(rows, None).collect()} == {0.5}


def test_quality_accuracy_on_held_out_documents(spark):
    from feedlake.llm.queries import op5_quality
    got = op5_quality(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.95


# 6 top-k

@pytest.mark.parametrize("n,k", [(3, 10), (400, 10), (1500, 3)])
def test_index_search_equals_all_scores(n, k):
    rng = np.random.default_rng(n)
    x = rng.integers(-300, 300, (n, 16))
    x[n // 2:] = x[:n - n // 2]  # ties
    index = topk.Index(rng.permutation(n).astype(np.int64) * 10, x)
    for row in range(0, n, max(1, n // 25)):
        got_ids, got = index.search(index.x[row], index.ids[row], k)
        want = sorted((-int(s), int(i)) for s, i in zip(index.x @ index.x[row], index.ids) if i != index.ids[row])[:k]
        assert [(-int(s), int(i)) for s, i in zip(got, got_ids)] == want


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_a_shard_is_indexed_once(monkeypatch, size):
    import pyarrow as pa
    rng = np.random.default_rng(size)
    x = {i: rng.integers(-9, 9, rng.integers(1, 4)).tolist() for i in range(40)}
    rows = [(s, asked, i, x[i]) for s in (0, 2, 5) for asked in (False, True) for i in (range(s, 40, 3) if not asked else range(0, 40, 8))]
    rows += [(7, True, i, x[i]) for i in range(0, 40, 8)]  # a shard without rows of its own
    schema = pa.schema([("shard", pa.int32()), ("asked", pa.bool_()), ("vec_id", pa.int64()), ("x", pa.list_(pa.int64()))])
    batches = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema).to_batches(max_chunksize=size)
    built, plain = [], topk.Index
    monkeypatch.setattr(topk, "Index", lambda *a: built.append(len(a[0])) or plain(*a))
    got = [r for b in topk._found(iter(batches), 3, 2) for r in zip(*[c.to_pylist() for c in b.columns])]
    assert built == [len(range(s, 40, 3)) for s in (0, 2, 5)]
    full = {i: np.array(v + [0] * (3 - len(v))) for i, v in x.items()}
    want = [(q, i, int(full[q] @ full[i])) for s in (0, 2, 5) for q in range(0, 40, 8)
            for i in sorted((i for i in range(s, 40, 3) if i != q), key=lambda i: (-int(full[q] @ full[i]), i))[:2]]
    assert got == want


def test_top_k_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 8)
    rng = np.random.default_rng(8)
    rows = [(i, [float(v) for v in rng.normal(size=4)], "s") for i in range(0, 500, 20)] + [(100, [9.0, 9.0, 9.0, 9.0], "s")]
    bad = [(200, None, "s"), (5, [1.0, None, 0.0, 0.0], "s"), (6, [float("nan")] * 4, "s"), (7, [float("inf")] * 4, "s"), (None, [1.0] * 4, "s"), (8, [], "s")]
    schema = "vec_id long, embedding array<float>, score string"
    got = ids(topk.nearest(spark.createDataFrame(rows + bad, schema), lambda v: v % 100 == 0), "query_id", "rank", "vec_id", "score")
    vectors = {}
    for i, v, _ in sorted(rows + [(8, [], "s")], key=lambda r: (r[0], r[1])):
        vectors.setdefault(i, np.floor(1024 * np.array(np.array(v, np.float32), float)).astype(int) if v else np.zeros(4, int))
    want = []
    for q in vectors:
        if q % 100 == 0:
            best = sorted((-int(vectors[q] @ v), i) for i, v in vectors.items() if i != q)[:10]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == sorted(want, key=str)
    assert topk.nearest(spark.createDataFrame([], schema), lambda v: v % 100 == 0).count() == 0


# 7 mixing

def test_poisson_counts_follow_the_rates(docs):
    rows = [(i, "t", "en", "hot" if i % 3 else f"s{i % 5}", 1) for i in range(6000)]
    df = docs(rows)
    got = mixing.mix(df, weights={"hot": 1.0, "s0": 3.0, "s1": 0.0}, total=9000)
    by = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert set(by) == {"hot", "s0"} and abs(by["hot"] - 2250) < 200 and abs(by["s0"] - 6750) < 350
    assert ids(got, "doc_id", "copy_no", "shuffle_key") == ids(mixing.mix(df, weights={"hot": 1.0, "s0": 3.0, "s1": 0.0}, total=9000), "doc_id", "copy_no", "shuffle_key")


def test_poisson_inverse(spark):
    import math
    rates = [0.0, 0.3, 1.0, 7.5, 190.0, 900.0, 1e6]
    table = spark.createDataFrame([(str(r), r) for r in rates] + [(None, 2.0)], "_source string, rate double")
    got = {r["_source"]: r for r in mixing.poisson_steps(table).collect()}
    assert len(got) == 8 and (got["0.0"]["first"], got["0.0"]["steps"]) == (0, [1.0])
    assert got["190.0"]["first"] == 0 and got["900.0"]["first"] == 510 and len(got["1000000.0"]["steps"]) < 30_000
    for rate in rates[1:]:
        first, steps, total = got[str(rate)]["first"], got[str(rate)]["steps"], 0.0
        for k, c in enumerate(steps, first):
            total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
            assert c == pytest.approx(total, abs=1e-8)
        assert total == pytest.approx(1, abs=1e-8) and steps == sorted(steps)


@pytest.mark.parametrize("n", [1, 2, 3, 8, 43, 100])
def test_steps_are_found_by_halving(spark, n):
    rng = random.Random(n)
    steps = sorted(rng.choices([i / 50 for i in range(50)], k=n))  # ties
    asked = [i / 100 for i in range(101)]
    rows = spark.createDataFrame([(steps, [1 << e for e in range(n.bit_length() - 1, -1, -1)], u) for u in asked],
                                 "steps array<double>, strides array<int>, u double")
    got = [r[0] for r in rows.select(mixing.steps_up_to(F.col("steps"), F.col("strides"), F.col("u"))).collect()]
    assert got == [sum(c <= u for c in steps) for u in asked]


def test_a_rare_source_of_a_large_weight(docs):
    df = docs([(1, "rare", "en", "rare", 4)] + [(i, "t", "en", "hot", 1) for i in range(2, 60)])
    by = {r["source"]: r["count"] for r in mixing.mix(df, weights={"rare": 99.0, "hot": 1.0}, total=200_000).groupBy("source").count().collect()}
    assert abs(by["rare"] - 198_000) < 2300 and abs(by["hot"] - 2000) < 250


def test_odd_weights(docs):
    df = docs([(i, "t", "en", [None, "None", "a"][i % 3], 1) for i in range(30)])
    assert mixing.mix(df, weights={}).count() == 0
    rates = {r["_source"]: r["rate"] for r in mixing.source_rates(df, "source", {None: 5.0, "a": 1.0, "gone": 1.0}, 20).collect()}
    assert rates == {None: 0.0, "None": 0.0, "a": 2.0}


def test_salted_rates_give_the_same_rows(docs, monkeypatch):
    df = docs([(i, f"t{i}", "en", f"s{i % 4}" if i % 9 else None, 1) for i in range(300)])
    want = ids(mixing.mix(df), "doc_id", "source", "copy_no", "shuffle_key")
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert ids(mixing.mix(df), "doc_id", "source", "copy_no", "shuffle_key") == want


def test_mixing_odd_rows(odd):
    got = mixing.mix(odd, total=40)
    assert got.columns == odd.columns + ["copy_no", "shuffle_key"]
    assert got.where("doc_id = 1").count() % 2 == 0
    assert mixing.mix(odd.limit(0)).count() == 0
    again = mixing.mix(got)
    assert again.columns == got.columns


# 8 near-dedup

def _brute_near(rows):
    sets = []
    for _, t in rows:
        words = (t or "").encode().lower().split()
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    at = list(range(len(rows)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                at[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)), d == least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def _near_rows():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, base = [], []
    for i in range(150):
        if base and rng.random() < 0.7:
            words = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words[rng.randint(0, 20):]
        else:
            words = rng.choices(vocabulary, k=rng.choice([3, 5, 60, 120]))
            base.append(words)
        rows.append((i * 3 % 151, (" " if rng.random() < 0.5 else "\n").join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows


@pytest.mark.parametrize("block", [1024, 2])
def test_near_dedup_equals_all_pairs(docs, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    if block == 2:
        monkeypatch.setattr(near_dedup, "BROADCAST_IDS", 0)
    rows = _near_rows()
    assert ids(near_dedup.near_duplicates(docs(rows)), "doc_id", "n_shingles", "component_id", "kept") == _brute_near(rows)


def test_near_dedup_links_whole_buckets_by_a_forest(spark, monkeypatch):
    # one bucket: a large component, members near some of it, members near each other, one apart
    rng = np.random.default_rng(10)
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    base = np.sort(rng.integers(0, 1 << 63, (3, 100)).astype(np.uint64), axis=1)
    kind = [0] * 8 + [1] * 6 + [2] + [0] * 3
    sets = [np.sort(np.r_[base[k][:95], rng.integers(0, 1 << 63, 5).astype(np.uint64)]) for k in kind]
    sig = near_dedup.signatures(sets)
    sig[:, :4] = 7   # all share the first band
    n = len(kind)
    rows = spark.createDataFrame([(i, bytearray(sig[i].tobytes())) for i in range(n)], "doc_id long, signature binary")
    full = spark.createDataFrame([(i, bytearray(sets[i].tobytes())) for i in range(n)], "doc_id long, hashes binary")
    members = spark.createDataFrame([(7, 0, i, 0 if i < 8 else i) for i in range(n)], "bucket long, band int, doc_id long, component long")
    links = ids(near_dedup.rest_of_buckets(members, rows, full), "a", "b")
    assert all(kind[a] == kind[b] for a, b in links)
    joined = {r.node: r.component for r in components.components(
        spark.createDataFrame(links + [(i, 0) for i in range(1, 8)], "a long, b long")).collect()}
    assert [joined.get(i, i) for i in range(n)] == [0] * 8 + [8] * 6 + [14] + [0] * 3
    # of one pair of blocks less links than members; of another band nothing, as the pairs agree in an earlier one
    own = near_dedup.forest(np.arange(n), 0, sig, sets, np.arange(n), np.arange(n), np.arange(n))
    assert len(own) == n - 3
    assert near_dedup.forest(np.arange(n), 1, sig, sets, np.arange(n), np.arange(n), np.arange(n)) == []


def test_components(spark):
    rng = random.Random(11)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(500, i) for i in range(501, 560)] + [(5, None), (8, 8)]
    at = {n: n for a, b in links if b is not None and a != b for n in (a, b)}
    for _ in range(400):
        for a, b in links:
            if b is not None and a != b:
                at[a] = at[b] = min(at[a], at[b])
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert ids(got, "node", "component") == sorted(at.items(), key=str)


def test_near_dedup_odd_rows(odd):
    got = near_dedup.near_duplicates(odd)
    rows = collections.Counter(ids(got, "doc_id", "n_shingles", "component_id", "kept"))
    assert rows[(1, 6, 1, True)] == 2 and rows[(2, 0, 2, True)] == 1 and rows[(4, 0, 4, True)] == 1 and rows[(None, 0, None, True)] == 1
    kept = near_dedup.one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == 9 and kept.where("doc_id = 1").count() == 1   # the row of id 1 is there twice
    assert near_dedup.near_duplicates(odd.limit(0)).count() == 0 and near_dedup.one_of_each(odd.limit(0)).count() == 0


def test_rows_without_an_id_are_deduplicated(docs):
    rng = random.Random(25)
    one, two, three = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(3))
    rows = docs([(5, one), (None, one), (None, one + " more"), (None, two), (None, two), (None, two + " more"), (None, three), (9, "x y z"), (None, None)])
    kept = near_dedup.one_of_each(rows)
    assert kept.columns == rows.columns
    got = collections.Counter((r.doc_id, (r.text or "")[:20]) for r in kept.collect())
    assert got == {(5, one[:20]): 1, (None, two[:20]): 1, (None, three[:20]): 1, (9, "x y z"): 1, (None, ""): 1}


# 9 toxicity

def test_cumulative_link_gradient_and_order():
    rng = np.random.default_rng(12)
    rows = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(600)]
    true = np.array([2.0, 1.0, 0.0, -1.0, 0.5, 0.0])
    z = np.array([true[r].sum() for r in rows]) + rng.logistic(size=600)
    grades = (z > 1).astype(int) + (z > 2.5) + (z > 4)
    w, t = toxicity.fit_weights(rows, grades, 6, ridge=1.0)

    def loss(v):
        s = np.array([v[:6][r].sum() for r in rows])
        above = np.column_stack([np.ones(600), 1 / (1 + np.exp(v[6:][None, :] - s[:, None])), np.zeros(600)])
        p = above[np.arange(600), grades] - above[np.arange(600), grades + 1]
        return -np.log(p).sum() + 0.5 * (v[:6] ** 2).sum()
    at = np.r_[w, t]
    slope = [(loss(at + 1e-4 * e) - loss(at - 1e-4 * e)) / 2e-4 for e in np.eye(9)]
    assert np.abs(slope).max() < 2 and (np.diff(t) > 0).all()


def test_toxicity_grades(docs):
    rng = random.Random(13)
    plain = [f"plain{i}" for i in range(50)]
    rows = []
    for i in range(400):
        words, bad = rng.choices(plain, k=30), i % 4 == 0
        if bad:
            words += ["scum"] * (i % 8 == 0) + ["moron", "clown"]
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(bad)))
    df = docs(rows, "doc_id long, text string, label int")
    model = toxicity.fit(df)
    got = {r.doc_id: r for r in toxicity.predict(df, model).collect()}
    assert all((got[i].score >= 0.5) == bool(bad) for i, _, bad in rows)
    assert got[8].expected_severity > got[4].expected_severity > got[1].expected_severity
    assert (np.diff(model.thresholds) >= 0).all()


def test_margin_grades():
    assert toxicity.margin_grades(np.array([5.0, 1.0, 3.0, 2.0, 6.0, 4.0])).tolist() == [3, 1, 2, 1, 3, 2]
    assert toxicity.margin_grades(np.array([2.0, 2.0, 2.0])).tolist() == [1, 1, 1]
    assert toxicity.margin_grades(np.array([1.0, 1.0, 1.0, 7.0])).tolist() == [1, 1, 1, 2]
    assert toxicity.margin_grades(np.array([])).tolist() == []


def test_margins_come_from_the_other_folds(spark):
    rng = np.random.default_rng(17)
    rows = [(sorted(rng.choice(5, rng.integers(0, 4), replace=False).tolist()), int(rng.random() < 0.4), int(rng.integers(0, 3))) for _ in range(300)]
    got = toxicity.fold_margins(spark.createDataFrame(rows, "at array<int>, grade int, fold int"), 5).collect()
    want = []
    for own in range(3):
        others = sorted((g, a) for a, g, f in rows if f != own)
        w, t = toxicity.fit_weights([np.array(a, int) for _, a in others], np.array([g for g, _ in others]), 5, rounds=150)
        want += [(tuple(a), round(float(w[np.array(a, int)].sum() - t[0]), 9)) for a, g, f in rows if f == own and g]
    assert sorted((tuple(r["at"]), round(r["margin"], 9)) for r in got) == sorted(want)


def test_severity_is_no_count_of_words(docs):
    rng = random.Random(18)
    plain = [f"plain{i}" for i in range(50)]
    # "vile" is in toxic rows alone; "rude" and "loud" are in clean rows too: one plain word outweighs two weak ones
    rows = []
    for i in range(900):
        words = rng.choices(plain, k=20)
        if i % 3 == 0:
            words += ["vile"] if i % 2 else ["rude", "loud"]
        elif i % 9 == 1:
            words += ["rude", "loud"]
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    model = toxicity.fit(docs(rows, "doc_id long, text string, label int"))
    one, two = (model.chances(" ".join(plain[:20]) + w).sum() for w in (" vile", " rude loud"))
    assert one > two


def test_toxicity_odd_rows(odd, docs):
    model = toxicity.fit(docs([(1, "a", 1)], "doc_id long, text string, label int"))
    rows = toxicity.predict(odd, model).collect()
    assert len(rows) == 10 and collections.Counter(r.doc_id for r in rows) == {1: 2, None: 2, **{i: 1 for i in (2, 3, 4, 7, 8, 9)}}
    assert {(round(r.score, 6), r.grade) for r in rows} == {(1.0, 1)}  # no words known: every text alike
    assert toxicity.predict(odd.limit(0), model).count() == 0
    none = toxicity.fit(docs([], "doc_id long, text string, label int"))
    assert {r.grade for r in toxicity.predict(odd, none).collect()} == {0}
    labels = docs([(3, 1), (None, 0), (1, None), (3, 1)], "doc_id long, label int")
    assert toxicity.sample_labels(labels, "doc_id", 3).count() == 3


def test_toxicity_on_held_out_documents(spark):
    from feedlake.llm.queries import op9_toxicity
    got = op9_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out")
    assert got.where("toxic = 0").agg(F.avg("predicted")).first()[0] < 0.01
    assert got.where("toxic = 1").agg(F.avg("predicted")).first()[0] > 0.8


# 2 decontamination

def _benchmark(docs):
    rng = random.Random(14)
    words = [f"term{i}" for i in range(900)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(18, 50)))) for i in range(30)]
    return items, docs(items, "item_id long, text string"), rng, words


def test_leaks_and_paraphrases_are_found_and_others_left(docs):
    items, bench, rng, words = _benchmark(docs)
    noise = lambda n: " ".join(rng.choices([f"other{i}" for i in range(500)] + words[:30], k=n))
    rows, want = [], {}
    for i in range(90):
        item, text = items[i % 30]
        if i % 3 == 0:
            body, want[i] = text.upper().replace(" ", ", "), [item]
        elif i % 3 == 1:  # a paraphrase: every sixth word replaced, the answer stays
            own = text.split()
            own = [f"new{j}" if j % 6 == 2 and j < len(own) * 3 // 4 else w for j, w in enumerate(own)]
            body, want[i] = " ".join(own), [item]
        else:  # a shared phrase
            body, want[i] = " ".join(text.split()[:5]), []
        rows.append((i, f"{noise(rng.randint(0, 200))} {body} {noise(rng.randint(0, 200))}"))
    got = {r.doc_id: r for r in decontaminate.contamination(docs(rows), bench).collect()}
    assert {i: r.item_ids for i, r in got.items()} == want
    assert all(r.contaminated == bool(want[i]) for i, r in got.items())
    assert {r.doc_id for r in decontaminate.uncontaminated(docs(rows), bench).collect()} == {i for i, w in want.items() if not w}


def test_benchmark_in_blocks(docs, monkeypatch):
    items, bench, rng, words = _benchmark(docs)
    df = docs([(i, t) for i, t in items[:8]] + [(50, items[0][1] + " " + items[20][1])])
    want = ids(decontaminate.contamination(df, bench), "doc_id", "contaminated", "item_ids")
    monkeypatch.setattr(decontaminate, "ITEMS", 7)
    assert ids(decontaminate.contamination(df, bench), "doc_id", "contaminated", "item_ids") == want
    assert want[-1] == (50, True, [0, 20]) or (50, True, [0, 20]) in want


def test_answer_check(docs):
    question = " ".join(f"q{i}" for i in range(20))
    bench = docs([(1, question, "forty two")], "item_id long, text string, answer string")
    part = " ".join(question.split()[:13])  # above WEAK, below STRONG
    df = docs([(1, part + " it is forty two"), (2, part + " it is something else"), (3, question)] + [(i, f"filler{i} it is else") for i in range(4, 40)])
    got = {r.doc_id: r.contaminated for r in decontaminate.contamination(df, bench, answer="answer").collect()}
    assert {i for i, bad in got.items() if bad} == {1, 3}


def test_common_subsequence():
    rng = np.random.default_rng(15)
    for _ in range(100):
        a, b = rng.integers(0, 5, rng.integers(1, 30)), rng.integers(0, 5, rng.integers(0, 30))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common_subsequence(a, b) == table[-1, -1]


def test_latent_space_keeps_the_items(docs):
    _, bench, *_ = _benchmark(docs)
    idf = np.ones(1 << decontaminate.BITS, np.float32)
    used, basis = decontaminate.latent_space(bench, "text", idf)
    texts = [r.text for r in bench.collect()]
    for at, w in decontaminate._vectors(texts, idf):  # 30 items are fewer than the rank: nothing is lost
        assert np.linalg.norm(w @ basis[np.searchsorted(used, at)]) == pytest.approx(1, abs=1e-3)
    used, small = decontaminate.latent_space(bench, "text", idf, rank=8)
    full = np.zeros((30, 1 << decontaminate.BITS))
    for row, (at, w) in zip(full, decontaminate._vectors(texts, idf)):
        row[at] = w
    best = np.linalg.svd(full[:, used], compute_uv=False)[:8]
    assert np.linalg.norm(full[:, used] @ small) >= 0.98 * np.linalg.norm(best)


def test_decontamination_odd_rows(odd, docs):
    bench = docs([(1, None), (2, ""), (None, "the cat sat on the mat and went away again"), (2, "le chat est sur la table"), (2, "le chat est sur la table")],
                 "item_id long, text string")
    rows = decontaminate.contamination(odd, bench).collect()
    assert len(rows) == 10
    assert {(r.doc_id, tuple(r.item_ids)) for r in rows if r.contaminated} == {(1, ()), (None, (2,))}
    assert decontaminate.contamination(odd.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(odd, bench.limit(0)).collect())
    kept = decontaminate.uncontaminated(odd, bench)
    assert kept.columns == odd.columns and kept.count() == 7


def _rare(rng, prefix):
    """Words that hardly any document has."""
    return lambda n: " ".join(f"{prefix}{rng.randrange(10**6)}" for _ in range(n))


def _planted(items, rng, noise):
    """A verbatim copy and a copy with every sixth word replaced of each item, in long documents."""
    rows, want = [], {}
    for i, (item, text) in enumerate(items):
        own = text.split()
        for kind in range(2):
            body = text if kind == 0 else " ".join(f"new{i}x{j}" if j % 6 == 2 else w for j, w in enumerate(own))
            rows.append((2 * i + kind, f"{noise(rng.randint(40, 90))} {body} {noise(rng.randint(40, 90))}"))
            want[2 * i + kind] = item
    return rows, want


def _missed(docs, rows, bench, want):
    got = {r.doc_id: r.item_ids for r in decontaminate.contamination(docs(rows), bench).collect()}
    assert len(got) == len(rows)
    return [i for i, item in want.items() if item not in got[i]]


def test_every_copy_and_paraphrase_of_a_large_benchmark(docs):
    rng = random.Random(21)
    words = [f"term{i}" for i in range(4000)]
    items = [(i, " ".join(rng.choices(words, weights=[1 / (n + 5) for n in range(4000)], k=rng.randint(15, 59)))) for i in range(1000)]
    rows, want = _planted(items, rng, _rare(rng, "n"))
    assert _missed(docs, rows, docs(items, "item_id long, text string"), want) == []


def test_copies_of_long_items(docs):
    rng = random.Random(22)
    words = [f"term{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=400))) for i in range(25)]
    rows, want = _planted(items, rng, _rare(rng, "n"))
    assert _missed(docs, rows, docs(items, "item_id long, text string"), want) == []


def test_short_items_between_rare_words(docs):
    rng = random.Random(23)
    words = [f"term{i}" for i in range(600)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(8, 12)))) for i in range(100)]
    rows, want = _planted(items, rng, _rare(rng, "n"))
    verbatim = {i: item for i, item in want.items() if i % 2 == 0}
    assert _missed(docs, rows, docs(items, "item_id long, text string"), verbatim) == []



# 10 WARC

def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")


def test_warc_round_trip(spark):
    tricky = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "é" * 600
    rows = [(1, "http://www.Example.com:80/a?b=1#c", tricky, "z"), (2, "https://example.com/a", "p" * 999, "z"), (3, "https://example.com/a", "p" * 999, "z"),
            (4, None, "p" * 1000, "z"), (9, "http://b.org", "p" * 1000, "z"), (9, "http://b.org", "p" * 1000, "z"), (5, "bad\r\nurl", None, None),
            (6, "http://[x", "", "z"), (None, "http://c.org/", "p" * 1000, "z"), (7, "http://a.org", "\r\n" * 700, "z"), (8, "http://a.org/", "y" * 300_000, "z")]
    path = warc.write_archives(_pages(spark, rows), archive=2000)
    got = warc.merged(warc.read_captures(spark, path))
    out = got.collect()
    by = {r.page_id: r for r in out}
    assert len(out) == len(rows) and all(r.intact for r in out)
    for page_id, _, html, _ in rows:
        body = (html or "").encode()
        assert (by[page_id].payload_bytes, by[page_id].payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
    assert {i: (r.record_type, r.refers_to) for i, r in by.items() if r.record_type == "revisit"} == {4: ("revisit", 9), None: ("revisit", 9)}
    assert [r.record_type for r in out if r.page_id == 9] == ["response"] * 2
    assert by[1].url_key == "com,example)/a?b=1" and by[5].url == "bad%0A%0Aurl"


def test_captures_come_in_one_order(spark):
    rows = [(i, f"http://h{i % 7}.org/{i % 3}" if i % 2 else "http://hot.org/", f"p{i}", None) for i in range(400)]
    runs = warc.read_captures(spark, warc.write_archives(_pages(spark, rows), archive=100))
    got = [(r.url_key, r.captured, r.page_id) for r in warc.merged(runs, per_range=60).collect()]
    assert got == sorted(got) and len(got) == 400 and runs.select("run").distinct().count() > 1


def test_loser_tree():
    rng = random.Random(16)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.choices(range(50), k=rng.randint(0, 20))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda v: v)) == sorted(v for r in runs for v in r)


def test_warc_odd_tables(spark):
    assert warc.archive_and_read(_pages(spark, [])).count() == 0
    assert warc.archive_and_read(_pages(spark, [(None, None, None, None)])).count() == 1
