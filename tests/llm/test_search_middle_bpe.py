"""Ranked search, fill-in-the-middle and byte-level BPE against brute force, and their results for odd rows."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from feedlake.llm import byte_bpe, fill_middle, ranked_search
from feedlake.llm.common import stored
from feedlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# 11 ranked search

def _brute_search(docs, items, k):
    """(item place, rank, doc id, score) by the plain formula over all documents."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(d, collections.Counter(cut(t))) for d, t in docs]
    n, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for place, (_, text) in enumerate(items):
        scored = []
        for d, bag in bags:
            m = 50 + (50 * sum(bag.values()) * n) // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m))
                        for t in set(cut(text)) if bag[t])
            if score > 0:
                scored.append((-score, d is None, d, score))
        out += [(place, rank, d, score) for rank, (_, _, d, score) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return out


def _search(spark, docs, items, k, **other):
    index = stored(ranked_search.build(spark.createDataFrame(docs, "doc_id long, text string")), "index")
    found = ranked_search.search(index, spark.createDataFrame([(i, t) for i, (_, t) in enumerate(items)], "item_id long, text string"), k=k)
    return sorted(tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("short,window,segment", [(32, 256, 1 << 16), (4, 2, 50), (1, 4, 1 << 16), (10**9, 3, 70)])
def test_search_equals_brute_force(spark, monkeypatch, short, window, segment):
    monkeypatch.setattr(ranked_search, "SHORT", short)
    monkeypatch.setattr(ranked_search, "WINDOW", window)
    monkeypatch.setattr(ranked_search, "SEGMENT_DOCS", segment)
    rng = random.Random(11)
    words = ["the", "of", *(f"w{i}" for i in range(60)), "Éa", "été", "日本", "x1"]
    weights = [60, 40, *(60 / (i + 1) for i in range(60)), 3, 3, 2, 1]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(30)]  # ties
    items = [(i, ", ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(25)] + [(25, "the the THE"), (26, "unknown"), (27, "")]
    assert _search(spark, docs, items, 7) == _brute_search(docs, items, 7)


def test_lists_skip_and_stay_exact(monkeypatch):
    monkeypatch.setattr(ranked_search, "WINDOW", 16)
    rng = np.random.default_rng(5)
    size = 5000
    lists = ranked_search.Lists(rng.integers(1, 400, size), size, 200 * size)
    for number, share in enumerate((0.9, 0.5, 0.2, 0.05, 0.01, 0.002)):
        docs = np.flatnonzero(rng.random(size) < share)
        lists.add(f"t{number}", docs, rng.integers(1, 9, len(docs)), [3, 700, 1600, 3000, 4600, 6200][number])
    scores = np.zeros(size, np.int64)
    for t in lists.docs:
        scores[lists.docs[t]] += lists.gains[t]
    seen, inner = [], lists._window
    lists._window = lambda here, *rest: seen.extend(here) or inner(here, *rest)
    docs, points = lists.best([f"t{i}" for i in range(6)], 5)
    want = np.lexsort((np.arange(size), -scores))[:5]
    assert docs.tolist() == want.tolist() and points.tolist() == scores[want].tolist()
    assert 0 < len(seen) < lists.windows / 2  # most windows were never entered


def test_search_odd_rows(spark, odd, odd_docs):
    index = stored(ranked_search.build(odd), "index")
    items = [(1, "the cat 12345"), (1, "the cat 12345"), (None, "WORD la"), (4, None), (5, "  "), (6, "zzz")]
    frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'a' as score", "1 as rank", "'n' as number")
    got = collections.Counter(tuple(r) for r in ranked_search.search(index, frame).select("item_id", "rank", "doc_id", "score").collect())
    want = collections.Counter((items[p][0], rank, d, score) for p, rank, d, score in
                               _brute_search([(d, t) for d, t, *_ in odd_docs], items, 50))
    assert got == want and (1, 1, 1, got_score(got, 1, 1)) in got
    assert ranked_search.search(index, frame.limit(0)).count() == 0
    none = stored(ranked_search.build(odd.limit(0)), "index")
    assert none.count() == 0 and ranked_search.search(none, frame).count() == 0


def got_score(rows, item, rank):
    return next(s for i, r, _, s in rows if (i, r) == (item, rank))


# 12 fill in the middle

def _brute_middle(key, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return key, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return key, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def _middle_texts():
    rng = random.Random(12)
    letters = ["a", "B", "é", "日", "😀", " ", "\n", "<", ">", "P", "S", "M", "letters", "1", "\x00"]
    return [(i, "".join(rng.choices(letters, k=rng.randint(0, 120)))) for i in range(300)] + [(900, "z" * 500), (901, "é" * 300), (902, "a<M>b")]


@pytest.mark.parametrize("frame", [4, 7, 64, 1 << 16])
def test_fill_in_middle_equals_brute_force(spark, frame):
    texts = _middle_texts()
    frames = fill_middle.store(spark.createDataFrame(texts, "doc_id long, text string"), frame=frame)
    made = fill_middle.transform(frames, frame=frame)
    want = {key: _brute_middle(key, text) for key, text in texts}
    got = {r.doc_id: r for r in fill_middle.digests(made).collect()}
    assert {(r.form) for r in got.values()} == {"plain", "psm", "spm"}
    for key, text in texts:
        _, n, form, prefix, middle, output = want[key]
        r = got[key]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle), key
        assert (r.output_sha256, r.restored_sha256) == (_sha(output), _sha(text)), key
    assert {r.doc_id: r.text for r in fill_middle.restore(made).collect()} == dict(texts)


def test_only_cut_frames_are_opened():
    frames = fill_middle.Frames(64)
    text = ("abc def, " * 2000).encode()
    held, n = frames.store(text)
    assert len(held) == -(-len(text) // 64) and n == 10_000
    opened, unpack = [], frames.unpack
    frames.unpack = lambda data: opened.append(1) or unpack(data)
    low, high = frames.cut(held, 1000, n), frames.cut(held, 7001, n)
    out = frames.join(frames.between(held, low[:2], high[:2]))
    assert len(opened) == 4  # each cut frame once to find the cut, once to copy what it holds
    assert b"".join(map(unpack, out)).decode() == "".join(re.findall("[A-Za-z]+|[^A-Za-z]", text.decode())[1000:7001])


def test_fill_in_middle_odd_rows(spark, odd, odd_docs):
    got = collections.Counter(tuple(r) for r in fill_middle.digests(fill_middle.transform(fill_middle.store(odd))).collect())
    want = collections.Counter((*row[:5], _sha(row[5]), _sha(t)) for d, t, *_ in odd_docs for row in [_brute_middle(d, t)])
    assert got == want
    assert fill_middle.digests(fill_middle.transform(fill_middle.store(odd.limit(0)))).count() == 0


# 13 byte-level BPE

@pytest.fixture(scope="module")
def public():
    ranks = byte_bpe.read_vocabulary(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def texts():
    return byte_bpe.Texts(byte_bpe.read_vocabulary(RANKS), public_tokenizers.PATTERN)


def _ids(texts, text):
    return np.frombuffer(texts.encode(text), "<u4").tolist()


def test_bpe_equals_public_encoder(texts, public):
    rng = random.Random(13)
    for _ in range(2000):
        text = "".join(rng.choices("abcdeétheing 日 \n\t'sx1٣\x1c\x85\xa0'll<|endoftext|>", k=rng.randint(0, 80)))
        assert _ids(texts, text) == public.encode_ordinary(text), repr(text)
    for text in ("a" * 70_000, "abthe" * 9_000, "日本語" * 5_000, " " * 40_000, "'" * 3_000, "x" * 257 + " y"):
        assert _ids(texts, text) == public.encode_ordinary(text)


def test_bpe_cuts_all_of_unicode_alike(texts, public):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 400):
        text = "".join(f"a{chr(c)}{chr(c)} {chr(c)}1" for c in points[start:start + 400])
        assert _ids(texts, text) == public.encode_ordinary(text), hex(points[start])


def test_bpe_kept_ids_change_nothing(public, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT", 3)
    few = byte_bpe.Texts(byte_bpe.read_vocabulary(RANKS), public_tokenizers.PATTERN)
    text = "one two three four five one two six " * 5
    assert _ids(few, text) == public.encode_ordinary(text) and len(few.kept) <= 3 and len(few.aged) <= 3


def _plain_merge(ranks, word):
    """Join the pair of the lowest rank, the leftmost of equal ones, until none has a rank."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while found := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
        _, i = min(found)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_merges_go_by_rank_then_from_the_left():
    rng = random.Random(14)
    for size in (20, 300, 3000):  # pieces in any order, so that a join may bring in a lower rank
        pieces = list({bytes(rng.choices(b"abc", k=rng.randint(2, 7))) for _ in range(size)})
        rng.shuffle(pieces)
        ranks = {bytes([b]): b for b in range(256)} | {p: 256 + i for i, p in enumerate(pieces)}
        encoder = byte_bpe.Encoder(ranks)
        for _ in range(400):
            word = bytes(rng.choices(b"abcd", k=rng.randint(1, 60)))
            assert encoder.merge(word) == _plain_merge(ranks, word)
        assert not any(encoder.words)  # the bitmap is empty again


def test_pre_tokens_in_one_queue_are_joined_as_if_alone(monkeypatch):
    rng = random.Random(15)
    for size in (20, 300, 3000):
        pieces = list({bytes(rng.choices(b"abc", k=rng.randint(2, 7))) for _ in range(size)})
        rng.shuffle(pieces)
        ranks = {bytes([b]): b for b in range(256)} | {p: 256 + i for i, p in enumerate(pieces)}
        encoder = byte_bpe.Encoder(ranks)
        words = [bytes(rng.choices(b"abcd", k=rng.randint(1, 30))) for _ in range(500)]
        want = [np.array(_plain_merge(ranks, w), "<u4").tobytes() for w in words]
        assert encoder.merge_all(words) == want and not any(encoder.words)
        whole = [np.array([ranks[w]] if w in ranks else _plain_merge(ranks, w), "<u4").tobytes() for w in words]
        for queue in (1, 40, byte_bpe.QUEUE):
            monkeypatch.setattr(byte_bpe, "QUEUE", queue)
            assert encoder.encode(words) == whole


def test_bpe_texts_together_equal_texts_alone(texts, public, monkeypatch):
    some = ["", "one  two", "zzxqj zzxqj", "caf\u00e9 \u4e2d\u6587 \U0001f600", "q" * 300, "one two"] * 3
    want = [np.array(public.encode_ordinary(t), "<u4").tobytes() for t in some]
    for at_once in (1, 30, byte_bpe.AT_ONCE):
        monkeypatch.setattr(byte_bpe, "AT_ONCE", at_once)
        assert list(texts.encode_all(some)) == want
    assert list(texts.encode_all([])) == []


def test_bpe_query_on_given_documents(spark, public):
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = public.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), _sha(r.text))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_byte_bpe"](spark, SF).collect()}
    assert got == want


def test_bpe_odd_rows(odd, odd_docs, public):
    encoded = byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    got = collections.Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in byte_bpe.decode(encoded, RANKS).collect())
    want = collections.Counter((d, np.array(public.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for d, t, *_ in odd_docs)
    assert got == want
    assert byte_bpe.encode(odd.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.Encoder({b"a": 0})
