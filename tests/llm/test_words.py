"""Byte-pair encoding, periodic runs and spelling variants against other implementations of the same definitions."""

import base64
import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from hybridloom.llm import bpe, periodic, spelling

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def byte_bpe():
    return bpe.read_ranks(RANKS)


def _strange_texts() -> list[str]:
    rng = random.Random(11)
    parts = ["a", "ab ", " ", "  ", "\n", "\t x", "'s", "'ll", "é", "日本", "　", " ", " b", "12", "!!", "=====", "<|endoftext|>", "🙂", "́", "\x1f", "᠎", "мир"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(300)] + ["word " * 3000, "x" * 20_000, " " * 5000, "日" * 3000]


def _sha(data: str | bytes) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_round_trip_of_all_documents(spark, sf, reference):
    got = {r["doc_id"]: r for r in bpe.op11_bpe_round_trip(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = reference.encode_ordinary(text or "")
        assert tuple(got[doc_id]) == (doc_id, len(ids), _sha(" ".join(map(str, ids))), _sha(text or ""))


def test_strange_texts_encode_as_the_library_would(spark, byte_bpe, reference, monkeypatch):
    texts = _strange_texts()
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, None), (None, ""), (3, texts[3])]
    df = spark.createDataFrame(rows, "k int, text string").withColumn("IDS", F.lit("old"))
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2000)
    out = bpe.encode_text(df, byte_bpe, offsets="at")
    assert out.columns == ["k", "text", "ids", "at"]
    for r in out.collect():
        data = (r["text"] or "").encode()
        assert r["ids"] == reference.encode_ordinary(r["text"] or "")
        assert b"".join(data[a:b] for a, b in zip(r["at"], [*r["at"][1:], len(data)])) == data and len(r["at"]) == len(r["ids"])
    back = bpe.decode_ids(out.select("text", "ids"), byte_bpe, as_text=True).collect()
    assert len(back) == len(rows) and all(r["decoded"] == (r["text"] or "") for r in back)
    assert bpe.encode_text(df.limit(0), byte_bpe).count() == 0


def test_decoding_of_split_and_unknown_ids(spark, byte_bpe, reference):
    ids = reference.encode_ordinary("日🙂")
    rows = [(ids,), (ids[:1],), (None,), ([],), ([ids[0], None, -1, 10 ** 6, *ids[1:]],)]
    df = spark.createDataFrame(rows, "ids array<int>")
    assert [bytes(r["decoded"]) for r in bpe.decode_ids(df, byte_bpe).collect()] == ["日🙂".encode(), reference.decode_bytes(ids[:1]), b"", b"", "日🙂".encode()]
    assert [r["t"] for r in bpe.decode_ids(df, byte_bpe, out="t", as_text=True).collect()] == ["日🙂", "�", "", "", "日🙂"]


def test_every_merge_is_found_from_the_ranks(byte_bpe):
    assert len(byte_bpe.halves) == 50_000 and all(a + b in set(byte_bpe.tokens) for a, b in byte_bpe.halves[:300])
    assert len(set(bpe.byte_characters())) == 256


def _runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) by trying all periods."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(24, 3 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def _words(rng: random.Random, n: int) -> list[bytes]:
    words = [str(rng.randrange(rng.choice([1, 2, 3, 50]) if rng.random() < 0.02 else 50)) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a = rng.randrange(max(1, n - 1))
        p, length = rng.choice([1, 2, 7, 8, 15, 16, 17, 31, 64, rng.randrange(1, n // 3 + 2)]), rng.randrange(1, n + 1)
        for i in range(a, min(n, a + length)):
            words[i] = words[a + (i - a) % p]
    return [w.encode() for w in words]


def _tricky() -> list[list[bytes]]:
    rng = random.Random(5)
    a, b = "a", "b"
    while len(b) < 700:
        a, b = b, b + a
    return [_words(rng, n) for n in (1, 23, 24, 25, 60, 200, 500, 900, 1400) for _ in range(6)] + [[b"a"] * 24, [b"a"] * 900, [c.encode() for c in b], [b"x", b"y"] * 300 + [b"y"] * 30]


def test_periodic_runs_equal_trying_all_periods(spark, monkeypatch):
    monkeypatch.setattr(periodic, "LEAST_TILE", 64)
    texts = [b" ".join(w).decode() for w in _tricky()]
    rows = [(i % 7, t, "c") for i, t in enumerate(texts)] + [(1, texts[-1], "c")] * 3 + [(None, None, "c"), (None, "", None), (2, " \t\n", "d"), (3, texts[-1] + " " + texts[-2], "d")]
    df = spark.createDataFrame(rows, "key int, text string, RUNS string").withColumn("__tiles", F.lit(1)).withColumn("t", F.array(F.lit(2)))
    out = periodic.collapse_runs(periodic.periodic_runs(df))
    assert out.columns == ["key", "text", "__tiles", "t", "runs", "collapsed"]
    got = out.collect()
    assert sorted((r["key"] is None, r["key"] or 0, r["text"] or "") for r in got) == sorted((k is None, k or 0, t or "") for k, t, _ in rows)
    for r in got:
        words = (r["text"] or "").encode().split()
        want = _runs(words)
        assert [tuple(x) for x in r["runs"]] == want
        gone = {i for s, n, p in want for i in range(s + p, s + n)}
        assert r["collapsed"].encode() == b" ".join(w for i, w in enumerate(words) if i not in gone)
    assert periodic.periodic_runs(df.limit(0)).count() == 0


def test_periodic_query_equals_the_contract(spark, sf):
    got = {r["doc_id"]: tuple(r)[1:] for r in periodic.op12_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs) and sum(v[0] > 0 for v in got.values()) > 5
    for doc_id, text in docs:
        words, h = (text or "").encode().split(), zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = _runs(words) if n < 4000 or h % 10 == 0 else [tuple(r) for r in _tile_runs(words)]
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {i for s, k, p in runs for i in range(s + p, s + k)}
        assert got[doc_id] == (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], _sha("".join(f"{s},{k},{p}\n" for s, k, p in runs)),
                               _sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def _tile_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """The same with arrays, for texts too long for loops."""
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    row, found = np.array([codes[w] for w in words]), {}
    for p in range(1, len(row) // 3 + 1):
        edges = np.diff(np.concatenate([[0], (row[p:] == row[:-p]).astype(np.int8), [0]]))
        for s, e in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            if e + p - s >= max(24, 3 * p):
                found.setdefault((s, e + p), p)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def _near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def test_near_words_equal_all_pairs(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(500)} | {"a" * n for n in range(1, 12)} | {"long" * 40, "long" * 39 + "lon", "é" * 3}
    df = spark.createDataFrame([(w, 1) for w in words] + [(None, 1), ("", 1), ("aaa", 2)], "word string, node int")
    got = [tuple(r) for r in spelling.near_words(df).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in words for b in words if a != b and _near(a, b)}
    assert spelling.near_words(df.limit(0)).count() == 0


def test_forms_lead_to_their_root(spark):
    counts = {"variant": 5, "varian": 25, "varians": 24, "arian": 125, "brian": 625, "bryan": 624, "alone": 7, "zrian": 625}
    rows = [(w, n, "x") for w, n in counts.items() if w != "alone"] + [("alone", 3, "x"), ("alone", 4, "y"), (None, 9, "x"), ("", 9, "x"), ("nothing", None, "x")]
    got = {r["word"]: tuple(r)[1:] for r in spelling.variant_forms(spark.createDataFrame(rows, "word string, n long, Root string")).select("word", "n", "n_near", "form", "form_n", "root").collect()}
    assert got["variant"] == (5, 2, "varian", 25, "brian") and got["varian"] == (25, 3, "arian", 125, "brian") and got["arian"] == (125, 3, "brian", 625, "brian")
    assert got["brian"][2:] == (None, None, "brian") and got["alone"] == (7, 0, None, None, "alone") and got["nothing"] == (0, 0, None, None, "nothing") and len(got) == 9
    assert spelling.variant_forms(spark.createDataFrame([], "word string, n long")).count() == 0
