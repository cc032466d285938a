"""Operators against brute force on small, skewed fixtures."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hybridloom.config import ChunkSettings
from hybridloom.functions import encoders, text as tx
from hybridloom.operators import autoencoder, catalog, chunking, context, dml, evaluation as ev, fusion, topk


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(3)
    # A third of all rows are copies of one vector, so ties must fall to the smaller id.
    rows = [(i, [1.0, 2.0, 0.0, 1.0] if i % 3 == 0 else [float(rng.randint(-3, 3)) for _ in range(4)], rng.choice("ab")) for i in range(300)]
    queries = [(q, [float(rng.randint(-3, 3)) for _ in range(4)]) for q in range(17)] + [(17, [0.0] * 4)]
    return (spark.createDataFrame(rows, "id long, dense array<double>, kind string").repartition(5),
            spark.createDataFrame(queries, "query_id long, dense array<double>"), rows, queries)


def brute_cosine(rows, queries, k):
    out = set()
    for q, v in queries:
        def score(w):
            n = math.sqrt(sum(x * x for x in v)) * math.sqrt(sum(x * x for x in w))
            return sum(a * b for a, b in zip(v, w)) / n if n else 0.0
        ranked = sorted(((-score(w), i) for i, w, _ in rows))[:k]
        out |= {(q, i, r + 1) for r, (_, i) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("block_bytes", [topk.QUERY_BLOCK_BYTES, 32 * 5])
def test_dense_topk_is_exact(vectors, block_bytes):
    points, queries, rows, asked = vectors
    got = topk.dense_topk(points, queries, 7, block_bytes=block_bytes).collect()
    assert {(r["query_id"], r["id"], r["rn"]) for r in got} == brute_cosine(rows, asked, 7)


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(["hot"] + rng.choices(words, k=rng.randint(1, 12)) + (["hot"] * 3 if i % 3 == 0 else []))) for i in range(120)]
    asked = [(q, " ".join(rng.choices(words, k=4) + (["hot"] if q % 2 else []))) for q in range(9)] + [(9, "unknown")]
    encode = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string").withColumn("sparse", encoders.sparse_terms(F.col("text")))
    return encode(docs, "id"), encode(asked, "query_id"), docs, asked


@pytest.mark.parametrize("block_bytes", [topk.QUERY_BLOCK_BYTES, 600])
def test_sparse_topk_is_exact(texts, block_bytes):
    points, queries, docs, asked = texts
    tf = {i: defaultdict(int) for i, _ in docs}
    for i, t in docs:
        for w in t.split():
            tf[i][w] += 1
    df = defaultdict(int)
    for d in tf.values():
        for w in d:
            df[w] += 1
    want = set()
    for q, t in asked:
        counts = defaultdict(int)
        for w in t.split():
            counts[w] += 1
        idf = lambda w: math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5))
        scored = [(-round(sum(math.log1p(n) * math.log1p(tf[i][w]) * idf(w) for w, n in counts.items() if w in tf[i]), 9), i) for i, _ in docs if set(counts) & set(tf[i])]
        want |= {(q, i, r + 1) for r, (_, i) in enumerate(sorted(scored)[:6])}
    got = topk.sparse_topk(points, queries, 6, block_bytes=block_bytes).collect()
    assert {(r["query_id"], r["id"], r["rn"]) for r in got} == want


def test_topk_per_group_with_a_hot_group(spark):
    rows = [("hot" if i % 3 else "cold", (i * 37) % 101, i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(9)
    got = topk.topk_per_group(df, ["k"], [F.desc("v"), F.asc("id")], 5, lanes=4).collect()
    want = {(k, i, r + 1) for k in ("hot", "cold") for r, (_, i) in enumerate(sorted((-v, i) for kk, v, i in rows if kk == k)[:5])}
    assert {(r["k"], r["id"], r["rn"]) for r in got} == want


def ranked(spark, ids, scores=None):
    return spark.createDataFrame([(0, x, float((scores or range(len(ids), 0, -1))[i]), i + 1) for i, x in enumerate(ids)], "query_id int, id string, score double, rn int")


def test_rrf_and_zero_weight(spark):
    d, s = ranked(spark, ["d1", "d2", "shared"]), ranked(spark, ["s1", "shared", "s2"])
    got = {r["id"]: r["score"] for r in fusion.rrf_fuse({"d": (d, 1.0), "s": (s, 1.0)}, 10).collect()}
    assert got["shared"] == pytest.approx(1 / 63 + 1 / 62) and got["d1"] == got["s1"] == pytest.approx(1 / 61)
    only = fusion.rrf_fuse({"d": (d, 0.0), "s": (s, 1.2)}, 10).collect()
    assert {r["id"] for r in only} == {"s1", "shared", "s2"}
    assert fusion.rrf_fuse({"d": (d, 0.0), "s": (s, 0.0)}, 10).count() == 0


def test_merge_normalised_invariants(spark):
    d, s = ranked(spark, ["a", "b", "c"], [3.0, 2.0, 1.0]), ranked(spark, ["c", "z"], [5.0, 5.0])
    got = {r["id"]: r for r in fusion.merge_normalised(d, s).collect()}
    assert {k: r["signal"] for k, r in got.items()} == {"a": "dense", "b": "dense", "c": "both", "z": "sparse"}
    assert got["a"]["dense_norm"] == 1.0 and got["c"]["dense_norm"] == 0.0 and got["z"]["sparse_norm"] == got["c"]["sparse_norm"] == 1.0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8])
def test_u_shape(spark, n):
    df = spark.createDataFrame([(0, i) for i in range(1, n + 1)], "query_id int, rn int")
    got = [r["rn"] for r in fusion.u_shape(df, ["query_id"]).orderBy("position").collect()]
    items = list(range(1, n + 1))
    half = (n + 1) // 2
    assert got == (items if n <= 2 else items[:half] + items[half:][::-1])


@pytest.mark.parametrize("given, n", [([2, 0, 2, 9, -1], 4), ([], 3), ([0], 0), ([1, 0], 2)])
def test_permutation_repair(spark, given, n):
    got = spark.createDataFrame([(given, n)], "g array<int>, n int").select(fusion.repair_permutation(F.col("g"), F.col("n")).alias("p")).first()["p"]
    assert sorted(got) == list(range(n)) and got[:len([g for g in dict.fromkeys(given) if 0 <= g < n])] == [g for g in dict.fromkeys(given) if 0 <= g < n]


def brute_merge(dense, resolved):
    seen, kept = set(), {}
    for source, items in (("dense", [(i, []) for i in dense]), ("sparse_resolved", resolved)):
        for ident, parts in items:
            if ident in seen:
                if ident in kept and source not in kept[ident]:
                    kept[ident].append(source)
                continue
            if parts and all(p in seen for p in parts):
                continue
            seen |= {ident, *parts}
            kept[ident] = [source]
    return kept


def test_merge_with_sources_follows_the_fold(spark):
    rng = random.Random(1)
    for _ in range(3):
        dense = rng.sample(range(8), 3)
        lists = [sorted(rng.sample(range(8), rng.randint(1, 3)), key=str) for _ in range(5)]
        resolved = [("+".join(map(str, p)), list(map(str, p))) for p in lists]
        d = spark.createDataFrame([(0, i, r + 1) for r, i in enumerate(dense)], "query_id int, id long, rn int")
        s = spark.createDataFrame([(0, i, r + 1, [int(x) for x in p]) for r, (i, p) in enumerate(resolved)], "query_id int, id string, rn int, constituent_ids array<bigint>")
        got = fusion.merge_with_sources(d, s).orderBy("rank").collect()
        assert [(r["id"], r["sources"]) for r in got] == list(brute_merge(list(map(str, dense)), resolved).items())


def test_resolve_drops_dangling_and_keeps_unpointed(spark):
    hits = spark.createDataFrame([(0, "s1", 2.0, 1, [2, 1], "t", "own", 3), (0, "s2", 1.0, 2, [], "alone", "own", 4), (0, "s3", 0.5, 3, [99], "x", "y", 1)],
                                 "query_id int, sparse_id string, score double, rn int, dense_chunk_ids array<bigint>, text string, title string, token_count long")
    dense = spark.createDataFrame([(1, "one", "T1", 10), (2, "two", "", 20)], "id long, text string, title string, token_count long")
    got = {r["sparse_id"]: r for r in fusion.resolve_sparse(hits, dense).collect()}
    assert set(got) == {"s1", "s2"}
    assert (got["s1"]["id"], got["s1"]["text"], got["s1"]["token_count"], got["s1"]["title"]) == ("1+2", "two\n\n---\n\none", 30, "T1")
    assert got["s2"]["text"] == "alone"


def test_bibliography_fold(spark):
    rng = random.Random(2)
    rows = [(q, f"t{rng.randint(0, 2)}", "f", float(-r), r, rng.choice(["", "x1"]), rng.choice([None, ["A"]]), rng.choice([None, 2020]), f"p{r}") for q in range(30) for r in range(1, 7)]
    df = spark.createDataFrame(rows, "query_id int, title string, source_file string, score double, rn int, arxiv_id string, authors array<string>, year int, publisher string")
    want = {}
    for q, title, _, _, _, arxiv, authors, year, pub in rows:
        kept = want.setdefault(q, {}).get(title)
        if kept is None or (arxiv and not kept[0]) or (authors and not kept[1]) or (year and not kept[2]):
            want[q][title] = (arxiv, authors, year, pub)
    for r in context.bibliography(df).collect():
        a, au, y, p = want[r["query_id"]][r["title"]]
        assert (r["arxiv_id"], r["authors"], r["year"], r["publisher"]) == (a, ", ".join(au or []), y, p)
        assert list(want[r["query_id"]]).index(r["title"]) + 1 == r["source_id"]


def brute_budget(tokens, seed, budget):
    lo, hi, total, kept = 0, max(tokens), tokens[seed], {seed}
    below, above = seed - 1, seed + 1
    while total < budget and (below >= lo or above <= hi):
        for at, ok in ((below, below >= lo), (above, above <= hi)):
            if total < budget and ok and at in tokens:
                kept.add(at)
                total += tokens[at]
        below, above = below - 1, above + 1
    return kept


def test_budget_expansion(spark):
    rng = random.Random(4)
    tokens = {i: rng.randint(1, 120) for i in range(80) if rng.random() > 0.1}
    points = spark.createDataFrame([("f", i, t, f"x{i}") for i, t in tokens.items()], "source_file string, chunk_index int, token_count long, text string")
    seeds = points.withColumn("query_id", F.col("chunk_index"))
    got = defaultdict(set)
    for r in context.budget_expand(seeds, points, 700).collect():
        got[r["query_id"]].add(r["chunk_index"])
    assert got == {s: brute_budget(tokens, s, 700) for s in tokens}


def test_budget_expansion_has_no_reach(spark):
    points = spark.range(300).selectExpr("'f' AS source_file", "CAST(id AS INT) AS chunk_index", "30L AS token_count", "'x' AS text")
    seeds = points.filter("chunk_index IN (0, 150)").withColumn("query_id", F.col("chunk_index"))
    counts = {r["query_id"]: r["count"] for r in context.budget_expand(seeds, points, 4000).groupBy("query_id").count().collect()}
    assert counts == {0: 134, 150: 134}


def test_list_books_takes_attributes_together(spark):
    rows = [(1, "f", "", "p0"), (2, "f", "T", "p1"), (3, "f", "U", "p2"), (4, "g", "", "q0"), (5, "g", "", "q1")]
    got = {r["source_file"]: (r["book_title"], r["publisher"], r["chunk_count"]) for r in catalog.list_books(
        spark.createDataFrame(rows, "id int, source_file string, book_title string, publisher string")).collect()}
    assert got == {"f": ("T", "p1", 3), "g": ("", "q1", 2)}


def test_positions_and_batches(spark):
    df = spark.range(0, 1000, 3).repartition(7)
    got = sorted((r["id"], r["position"]) for r in catalog.dense_position(df, "id").collect())
    assert got == [(i * 3, i) for i in range(334)]
    cut = autoencoder.seeded_batches(df, "id", 1, 50, drop_last=True).groupBy("batch").count().collect()
    assert sorted((r["batch"], r["count"]) for r in cut) == [(b, 50) for b in range(6)]


def test_encoder_paths_agree(spark, vectors):
    points = vectors[0].select("id", "dense")
    weights = spark.createDataFrame([(f, [float((f * 7 + i * 3) % 5 - 2) for i in range(4)]) for f in range(6)], "feature long, row array<double>")
    bias = spark.createDataFrame([([0.5, 0.0, -0.5, 0.25],)], "mean array<double>")
    fast = {(r["id"], r["feature"]): r["activation"] for r in autoencoder.encode_topk(points, autoencoder.load_encoder(weights, bias), 3).collect()}
    long = weights.select("feature", F.posexplode("row").alias("pos", "w"))
    slow = autoencoder.encode_long(points, long, bias.select(F.posexplode("mean").alias("pos", "mean")), autoencoder.row_norms(weights, "feature", "row"), 3)
    other = {(r["id"], r["feature"]): r["activation"] for r in slow.collect()}
    assert fast.keys() == other.keys() and all(abs(fast[k] - other[k]) < 1e-9 for k in fast)


def test_percentile_matches_numpy(spark):
    rng = np.random.default_rng(0)
    rows = [([float(x) for x in rng.random(n)],) for n in (1, 2, 5, 20, 21)]
    got = spark.createDataFrame(rows, "v array<double>").select("v", chunking.percentile_of(F.col("v"), 95.0).alias("p")).collect()
    assert all(abs(r["p"] - np.percentile(r["v"], 95)) < 1e-12 for r in got)


def test_boundaries(spark):
    a, b = [1.0, 0.0], [0.0, 1.0]
    df = spark.createDataFrame([([a, a, a, b, b, b],), ([a] * 6,), ([a],)], "v array<array<double>>")
    got = [r["c"] for r in df.select(chunking.boundaries(chunking.embedded_distances(F.col("v")), 50.0).alias("c")).collect()]
    assert got == [[2], [], []]
    assert df.select(chunking.boundaries(chunking.embedded_distances(F.col("v")), 50.0, 2.0).alias("c")).first()["c"] == []


@pytest.mark.parametrize("size", [3, 10, 40])
def test_recursive_split_loses_nothing(size):
    rng = random.Random(size)
    text = "".join(rng.choice(["word ", "longerword, ", "End. ", "\n\n", "x" * 30]) for _ in range(120))
    parts = chunking.split_recursively(text, size, chunking.estimate_tokens)
    assert "".join("".join(parts).split()) == "".join(text.split())
    assert all(chunking.estimate_tokens(p) <= size for p in parts)


def test_zero_overlap_repeats_nothing():
    assert chunking.merge_pieces(["Is.", "x" * 12], 3, chunking.estimate_tokens, 0) == ["Is.", "x" * 12]
    parts = chunking.split_recursively("Is. " + "word " * 40, 5, chunking.estimate_tokens)
    assert "".join("".join(parts).split()) == "Is." + "word" * 40


@pytest.mark.parametrize("pieces, merged", [
    (["aaaa", "b", "cccc", "d"], ["aaaa b", "cccc d"]), (["a", "bbbb", "cccc"], ["a bbbb", "cccc"]), (["a"], ["a"]), ([], []),
    (["a", "b", "cccc"], ["a b", "cccc"]), (["a", "b"], ["a b"]), (["a", "bbb", "c", "d", "eee"], ["a bbb c d", "eee"])])
def test_runts(spark, pieces, merged):
    rows = spark.createDataFrame([(pieces,)], "p array<string>")
    assert rows.select(chunking.merged_runts(F.col("p"), 3, F.length).alias("m")).first()["m"] == merged


def test_paragraph_packing():
    para = lambda n: "x" * (4 * n)
    assert [len(c) for c in chunking.pack_paragraphs([para(3), para(3), para(3)], 7, 3)] == [12 + 2 + 12, 12 + 2 + 12]
    assert chunking.pack_paragraphs([para(3), "aaaa. bbbb. cccc.", para(2)], 3, 0) == [para(3), "aaaa. bbbb. cccc.", para(2)]
    long = chunking.pack_paragraphs(["Aaaa aaaa. Bbbb bbbb. Cccc cccc."], 4, 0)
    assert long == ["Aaaa aaaa. Bbbb bbbb.", "Cccc cccc."]


@pytest.mark.parametrize("seed", range(4))
def test_paragraph_packing_invariants(seed):
    rng, size, overlap = random.Random(seed), 30, 8
    paragraphs = [f"p{i} " + "y" * rng.randint(0, 90) for i in range(40)]
    chunks = [c.split("\n\n") for c in chunking.pack_paragraphs(paragraphs, size, overlap)]
    cost = lambda parts: sum(len(p) // 4 for p in parts)
    at = 0
    for before, chunk in zip([[]] + chunks, chunks):
        shared = next(n for n in range(len(chunk), -1, -1) if chunk[:n] == before[len(before) - n:])
        assert chunk == paragraphs[at - shared:at - shared + len(chunk)] and cost(chunk[:shared]) <= overlap
        assert cost(chunk) <= size or len(chunk) - shared == 1
        at += len(chunk) - shared
    assert at == len(paragraphs)


def test_paper_chunk_fields(spark):
    rows = spark.createDataFrame([("1.2", "\n\n".join("z" * 80 for _ in range(5)), "abs")], "arxiv_id string, text string, abstract string")
    got = chunking.paper_chunks(rows, 45, 0).orderBy("chunk_index").collect()
    assert [(r["id"], r["chunk_count"], r["abstract"]) for r in got] == [("1.2_chunk_0", 3, "abs"), ("1.2_chunk_1", 3, None), ("1.2_chunk_2", 3, None)]


def test_small_tables_are_spread_and_large_ones_are_not(spark, sf, monkeypatch):
    from hybridloom import session
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert "RoundRobin" in session.spread(df)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(session, "SPREAD_BYTES", 10)
    assert session.spread(df) is df


def test_chunk_section_rules(spark):
    body = " ".join(f"Sentence number {i} talks about topic {i // 6}." for i in range(24))
    rows = spark.createDataFrame([(0, "T", ""), (1, "T", "short"), (2, "(no title)", body), (3, "Big", body * 3)], "k int, title string, content string")
    got = defaultdict(list)
    for r in chunking.chunk_sections(rows, ChunkSettings(chunk_size=80, min_chunk_tokens=10)).orderBy("k", "chunk_index").collect():
        got[r["k"]].append(r)
    assert [r["text"] for r in got[0]] == ["T"] and not got[0][0]["has_heading_context"]
    assert [r["text"] for r in got[1]] == ["## T\n\nshort"]
    assert len(got[2]) > 1 and not any(r["text"].startswith("## ") for r in got[2])
    assert all(r["text"].startswith("## Big\n\n") and r["chunk_count"] == len(got[3]) for r in got[3])


def test_hit_rank_methods(spark):
    base = "query_id int, rn int, source_file string, chunk_index int, text string, seed_file string, range_low int, range_high int, seed_text string"
    rows = [(0, 1, "x", 9, "aa bb", "f", 3, 5, "cc dd"), (0, 2, "f", 4, "zz", "f", 3, 5, "cc dd"), (1, 1, "x", 1, "CC dd ee", "f", 3, 5, "cc dd"),
            (2, 1, "x", 1, "nothing", "f", 3, 5, "cc dd"), (3, 1, "x", 1, "cc", "f", 3, 5, "cc dd")]
    got = {r["query_id"]: (r["rank"], r["match_method"]) for r in ev.hit_rank(spark.createDataFrame(rows, base), ["query_id"]).collect()}
    assert got == {0: (2, "chunk_index"), 1: (1, "text_overlap"), 2: (None, "none"), 3: (None, "none")}


def test_latest_wins_and_patch(spark):
    rows = spark.createDataFrame([("hot", i, f"v{i}") for i in range(50)] + [("b", 1, "x")], "k string, ver int, v string")
    assert {(r["k"], r["v"]) for r in dml.latest_wins(rows, ["k"], "ver").collect()} == {("hot", "v49"), ("b", "x")}
    target = spark.createDataFrame([("1", "1", ""), ("2", "kept", "c")], "arxiv_id string, title string, category string")
    meta = spark.createDataFrame([("1", "New", "cat"), ("2", "Other", "cat2")], "arxiv_id string, title string, category string")
    got = {r["arxiv_id"]: r for r in dml.patch_blanks(target, meta, ["arxiv_id"], ["title", "category"], {"title": F.col("arxiv_id")}).collect()}
    assert (got["1"]["title"], got["1"]["category"], got["1"]["changed"]) == ("New", "cat", True)
    assert (got["2"]["title"], got["2"]["category"], got["2"]["changed"]) == ("kept", "c", False)


def test_chunks_by_a_tokenizer(spark, sf):
    from types import SimpleNamespace
    from hybridloom.functions.tokens import RankTokenizer
    quarters = SimpleNamespace(count=lambda text: len(text) // 4, column=lambda: tx.token_estimate)  # the default estimate as a tokenizer
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("source").alias("title"), F.col("text").alias("content"))
    settings = ChunkSettings(chunk_size=60, min_chunk_tokens=20)
    plain = chunking.chunk_sections(docs, settings).select("doc_id", "chunk_index", "text", "token_count")
    assert sorted(map(tuple, chunking.chunk_sections(docs, settings, tokenizer=quarters).select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    ranks = {bytes([b]): b for b in range(256)} | {b"th": 256, b"the": 257, b" the": 258, b"e ": 259, b"in": 260, b"ing": 261, b"tion": 300, b"ti": 262, b"on": 263}
    table = spark.createDataFrame([(bytearray(k), v) for k, v in ranks.items()], "token binary, rank int")
    tokenizer = RankTokenizer.from_table(table, r" ?\p{L}+|[^\p{L}]+")

    def naive(piece):
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            found = [ranks.get(a + b, 10 ** 9) for a, b in zip(parts, parts[1:])]
            if min(found) == 10 ** 9:
                break
            i = found.index(min(found))
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]

    for text in ["the thing, nation", "", "aaaa tttt", *[r["content"] or "" for r in docs.limit(40).collect()]]:
        assert tokenizer.ids(text) == [i for piece in tokenizer._find(text) for i in naive(piece.encode())]
    by_size = ChunkSettings(chunk_size=60, min_chunk_tokens=20, enable_semantic=False)
    out = chunking.chunk_sections(docs.withColumn("title", F.lit("")), by_size, tokenizer=tokenizer).collect()
    assert all(r["token_count"] == tokenizer.count(r["text"]) for r in out) and max(r["token_count"] for r in out) <= 2 * 60


def test_spaced_counts_and_few_passes():
    import public_tokenizers
    from hybridloom.functions.tokens import RankTokenizer
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    plain, spaced = RankTokenizer.from_file(path, pattern), RankTokenizer.from_file(path, pattern, spaced=True)
    rng = random.Random(5)
    bits = ["a", "Bee", " ", "  ", "\n", " \n", "\u00a0", "\x1c", "it's", " 's", "12", "é", "中文", "! ", "\r\n", "x" * 90]
    for text in ["", " ", *["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(400)]]:
        assert spaced.count(text) == plain.count(text)
    seen = []
    text = " ".join(f"{rng.choice(bits[:2])}{i}{rng.choice(['', '', ',', '.'])}" for i in range(4000))
    chunking.split_recursively(text, 96, lambda t: seen.append(len(t)) or spaced.count(t))
    assert sum(seen) < 10 * len(text)


def test_words_are_counted_once(spark, monkeypatch):
    import public_tokenizers
    import pyarrow as pa
    from hybridloom.functions import tokens
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    spaced = tokens.RankTokenizer.from_file(path, pattern, spaced=True)
    rng = random.Random(11)
    bits = ["a", "Bee", " ", " ", "  ", "\n", " \n", "\n\n", "\t", "\u00a0", "\x1c", "it's", " 's", "12", "é", "中文", "! ", ". ", "; ", ", ", "\r\n", "x" * 90, "#%&" * 30]
    odd = ["", " ", *["".join(rng.choice(bits) for _ in range(rng.randint(1, 300))) for _ in range(150)],
           *["\n".join(" ".join(rng.choice(["a", "Bee.", "c;", "xyzzy", "12,", "Ω!", "zq" * 30]) for _ in range(rng.randint(0, 60))) for _ in range(9)) for _ in range(60)]]
    segments = [[t] if i % 3 else [t[:len(t) // 2], t[len(t) // 2:]] for i, t in enumerate(odd)] + [[], None]
    for size, smallest in [(40, 12), (5, 2)]:
        settings = ChunkSettings(chunk_size=size, min_chunk_tokens=smallest)
        for runts in (True, False):
            by_words, plain = (chunking.recursive_udf(settings, spaced.count, runts, t).func(pa.array(segments, pa.list_(pa.string()))) for t in (spaced, None))
            assert by_words.to_pylist() == plain.to_pylist()
    assert all(spaced.fewer(t, n) == (spaced.count(t) < n) and spaced.exceeds(t, n) == (spaced.count(t) > n) for t in odd for n in (0, 1, 16, 60))
    plain = tokens.RankTokenizer.from_file(path, pattern)
    rows = spark.createDataFrame([(i, ["", "T"][i % 2], t) for i, t in enumerate([None, "A! B! " * 3, "中" * 300, "a b " * 20, *odd])], "k int, title string, content string").repartition(4)
    settings = ChunkSettings(chunk_size=40, min_chunk_tokens=12, min_sentences_for_semantic=4)
    chunks = lambda t: sorted(map(str, chunking.chunk_sections(rows, settings, tokenizer=t).collect()))
    assert chunks(spaced) == chunks(plain)
    wordy = {r["k"]: r["w"] for r in rows.select("k", spaced.wordy(F.coalesce("content", F.lit("")), 12).alias("w")).collect()}
    assert wordy[3] and not any(w and plain.count(t) < 12 for w, t in zip([wordy[k] for k in range(4, len(wordy))], odd))
    assert not rows.filter(plain.wordy(F.col("content"), 12)).count()
    pieces = [t.encode()[:100] for t in odd] + [b"a" * 50, b"ab" * 50]
    merged = [spaced._merged(p) for p in pieces if p]
    monkeypatch.setattr(tokens, "LIBRARY_BYTES", 0)
    assert merged == [spaced._merged(p) for p in pieces if p]

    fresh = tokens.RankTokenizer.from_file(path, pattern, spaced=True)
    monkeypatch.setattr(tokens, "REMEMBERED", 20)  # a corpus has more words than are remembered
    find, cut = fresh._find, []
    fresh._find = lambda t: cut.append(len(t)) or find(t)
    text = "\n".join(" ".join(f"w{rng.randint(0, 10 ** 6)}{rng.choice(['', ',', '.'])}" for _ in range(300)) for _ in range(10))
    chunking.recursive_udf(ChunkSettings(chunk_size=96, min_chunk_tokens=16), fresh.count, True, fresh).func(pa.array([[text]], pa.list_(pa.string())))
    assert sum(cut) < 1.5 * len(text)


def test_batches_are_small_and_cut_in_slices(spark, monkeypatch):
    import pyarrow as pa
    from pyspark.sql import types as T
    from hybridloom import session
    from hybridloom.functions import encoders, slices
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(64 << 20))
        monkeypatch.setattr(session, "BATCH_BYTES", 20_000)

        @F.arrow_udf(T.LongType())
        def batch_rows(texts: pa.Array) -> pa.Array:
            return pa.array([len(texts)] * len(texts), pa.int64())

        texts = session.spread(spark.range(4000).select(F.repeat(F.lit("x"), 100).alias("v")))
        assert texts.select(batch_rows("v").alias("n")).agg(F.max("n")).first()[0] < 400
    finally:
        spark.conf.set(key, before)
    rng = random.Random(3)
    lists = pa.array([None if i % 9 == 0 else [f"w{rng.randint(0, 50)}" for _ in range(i % 7)] for i in range(300)], pa.list_(pa.string()))
    seen, whole = [], encoders.count_terms(lists)
    monkeypatch.setattr(slices, "SLICE_BYTES", 500)
    cut = slices.in_slices(lambda part: seen.append(part.nbytes) or encoders.count_terms(part))(lists.slice(0))
    sets = lambda made: [sorted(zip(r["indices"], r["values"])) for r in made.to_pylist()]
    assert len(seen) > 5 and max(seen) < 1500 and sets(cut) == sets(whole)


def test_blocked_encoding_equals_the_whole(spark, tmp_path):
    import random
    from hybridloom.sources.store import CollectionStore
    rng = random.Random(2)
    vector = lambda: [round(rng.uniform(-1, 1), 3) for _ in range(6)]
    points = spark.createDataFrame([(i, vector()) for i in range(80)] + [(500, None)], "id long, dense array<double>")
    rows = [(f, vector()) for f in range(30)] + [(100, [0.5] * 6), (101, [0.5] * 6)]
    weights, bias = spark.createDataFrame(rows, "feature long, row array<double>"), spark.createDataFrame([([0.1] * 6,)], "mean array<double>")
    own = {f: 0.01 * f for f in range(10)}
    whole = autoencoder.encode_topk(points, autoencoder.load_encoder(weights, bias, own), 7, decimals=9)
    blocked = autoencoder.encode(points, weights, bias, own, 7, decimals=9, block_bytes=5 * 48)
    assert sorted(map(tuple, blocked.collect())) == sorted(map(tuple, whole.collect()))
    store = CollectionStore(spark, str(tmp_path / "c"))
    name = autoencoder.store_features(store, "coded", points, blocked)
    kept = {r["id"]: r["sparse"] for r in store.read(name, "sparse").collect()}
    assert len(kept) == 81 and kept[500]["indices"] == [] and sum(len(v["indices"]) for v in kept.values()) == whole.count()


def test_hull_and_surface(spark):
    rng = random.Random(8)
    spots = [(rng.random(), rng.random()) for _ in range(300)] + [(0.5, 0.5)] * 50
    hull = ev.convex_hull(spark.createDataFrame(spots + [(None, 1.0), (float("nan"), 2.0)], "x double, y double").repartition(5), "x", "y", gathered=5)
    cross = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    assert set(hull) <= set(spots) and all(cross(a, b, p) >= -1e-12 for a, b in zip(hull, hull[1:] + hull[:1]) for p in spots)
    assert all(ev.inside(hull, p) for p in spots) and not ev.inside(hull, (1.5, 0.5)) and not ev.inside(hull[:2], hull[0])
    rows = [(0.2, 0.1, 2.0), (0.8, 0.3, 12.0), (0.5, 3.5, 5.0), (0.0, 1.0, 9.0), (0.4, None, 3.0), (0.4, 0.2, 0.5), (None, 1.0, 1.0)]
    out = {(round(r["gx"], 3), round(r["gy"], 3)): r["value"] for r in ev.lift_surface(spark.createDataFrame(rows, "f double, l double, v double"), "f", "l", "v", 4, 5, 0.4, 0.4).collect()}
    assert len(out) == 20 and out[0.2, 0.0] is None and out[0.2, 2.0] is None and out[0.4, 0.5] is not None and all(v is None or 1 <= v <= 10 for v in out.values())
    kept, cut = [(0.2, 0.1, 2.0), (0.8, 0.3, 12.0), (0.5, 2.0, 5.0)], (0.6, 0.5)
    w = [math.exp(-(((cut[0] - x) / 0.4) ** 2 + ((cut[1] - y) / 0.4) ** 2) / 2) for x, y, _ in kept]
    assert out[0.6, 0.5] == pytest.approx(min(10, sum(a * z for a, (_, _, z) in zip(w, kept)) / sum(w)))
    flat = spark.createDataFrame([(0.5, 0.1, 2.0)] * 5, "f double, l double, v double")
    assert ev.lift_surface(flat, "f", "l", "v").count() == 0 == ev.lift_surface(flat.limit(0), "f", "l", "v").count()


def test_posting_lists_hold_the_statistics(spark, tmp_path):
    """Document frequencies are the lengths of the lists; points are not encoded a second time for them."""
    from hybridloom.operators import postings
    points = spark.createDataFrame([(i, (["all", f"t{i % 3}"], [1.0, 2.0])) for i in range(20)] + [(20, ([], [])), (21, None)],
                                   "id long, sparse struct<indices array<string>, values array<double>>")
    postings.write_postings(postings.point_blocks(points, block_points=4), str(tmp_path / "p"))
    lists, plain = spark.read.parquet(str(tmp_path / "p")), topk.inverse_document_frequency(points)
    rows = lambda df: sorted((r["term"], r["df"], round(r["idf"], 12)) for r in df.collect())
    assert rows(postings.idf_of(postings.statistics_of(lists, points.count()))) == rows(plain) != []
    wanted = spark.createDataFrame([("t1",), ("none",)], "term string")
    assert rows(postings.idf_of(postings.statistics_of(lists, points.count(), wanted))) == [r for r in rows(plain) if r[0] == "t1"]
