"""Registered queries next to their SQL, and the operators under other parameters."""

import pytest
from pyspark.sql import functions as F

import compare_queries
from __spark_entry__ import queries
from hybridloom.llm import decontamination, mixing, preferences, sharding, suffixes, urls
from hybridloom.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, name):
    assert compare_queries.compare(QUERIES[name](spark, sf), compare_queries.connect(sf), SQL[name]).startswith("ok")


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    assert set(QUERIES) <= set(queries())


def _jump(key: int, shards: int) -> int:
    at, following = -1, 0
    while following < shards:
        at = following
        key = (key * 2862933555777941757 + 1) % 2 ** 64
        following = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


@pytest.mark.parametrize("shards", [1, 2, 8, 300])
def test_jump_hash_equals_the_loop(spark, shards):
    rows = spark.range(400).select((F.abs(F.xxhash64("id")) % (1 << 60)).alias("k")).withColumn("s", sharding.jump_shard(F.col("k"), shards)).collect()
    assert all(r["s"] == _jump(r["k"], shards) for r in rows)


def test_shards_keep_their_law(spark):
    docs = spark.sql("SELECT IF(id % 7 = 0, NULL, id % 200) AS doc_id, IF(id % 5 = 0, NULL, repeat('a ', id % 3)) AS text, 'x' AS Slot, array(id % 2) AS tags FROM range(600)")
    out = sharding.shard_by_key(docs, lanes=4)
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "tags", "shard", "slot", "grown_shard"] and len(rows) == 600
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len({r["shard"] for r in rows if r["doc_id"] == k}) <= 1 for k in {r["doc_id"] for r in rows})
    assert sharding.shard_by_key(docs.limit(0)).count() == 0


def test_rules_inline_and_joined_agree(spark):
    pages = spark.createDataFrame([(1, "http://A.example.NET/en/x?q"), (2, "https://example.com/de/"), (3, "http://notexample.com/de/1"), (4, None), (5, "no scheme"),
                                   (6, "x://b.org/fr/1#t"), (7, "http://q.net"), (8, "http://q.net/"), (8, "http://q.net/"), (9, "http://casino-bets.example/en/1")], "page_id int, url string")
    model = urls.train_url_filter(urls.labelled_urls(spark))
    want = {1: ("example.net/en/", "allow"), 2: ("example.com/de/", "block"), 3: (None, "allow"), 4: (None, "allow"), 5: (None, "allow"),
            6: ("org/fr/", "allow"), 7: (None, "allow"), 8: ("net/", "block"), 9: (None, "block")}
    for inline in (1000, 1):
        rows = urls.judge_urls(pages.withColumn("SCORE", F.lit(1)), urls.rule_table(spark), model, inline_rules=inline).collect()
        assert len(rows) == 10 and {r["page_id"]: (r["rule"], r["verdict"]) for r in rows if r["page_id"] != 7} == {k: v for k, v in want.items() if k != 7}
        assert next(r for r in rows if r["page_id"] == 7)["rule"] is None and next(r for r in rows if r["page_id"] == 4)["host"] == ""


def test_url_classifier_learns_its_table_and_empty_table_is_neutral(spark):
    labelled = urls.labelled_urls(spark)
    rows = urls.judge_urls(labelled, urls.rule_table(spark).limit(0), urls.train_url_filter(labelled)).collect()
    assert sum((r["score"] >= 0.5) == (r["label"] == 1) for r in rows) / len(rows) > 0.98
    assert urls.train_url_filter(labelled.limit(0)).first()["bias"] in (None, 0.0)


def test_swap_or_not_is_a_permutation(spark):
    for n in (1, 2, 37, 256):
        keys = mixing._round_keys(F.lit("s"), 0, 7, 24)
        places = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), keys)).collect()]
        assert sorted(places) == list(range(n))


def test_mix_holds_caps_and_targets(spark):
    rows = spark.sql("""SELECT IF(id % 50 = 0, NULL, id % 900) AS doc_id, CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE concat('s', id % 5) END AS source,
        IF(id % 11 = 0, NULL, id % 400) AS size FROM range(1000)""")
    out = mixing.mix(rows, lanes=4)
    sources = {r["sid"]: r for r in out.sources.collect()}
    joined = out.rows.join(out.taken(), ["sid", "row"], "left").collect()
    assert len(joined) == 1000 and all((r["taken"] or 0) <= 2 * r["size"] for r in joined)
    for sid, source in sources.items():
        taken = sum(r["taken"] or 0 for r in joined if r["sid"] == sid)
        assert abs(taken - source["target"]) <= max(4 * 64, 0.03 * source["target"])
    assert abs(sum(s["target"] for s in sources.values()) - 1.5 * sum(s["source_size"] for s in sources.values())) < 1e-3
    assert sorted(map(tuple, out.slots.collect())) == sorted(map(tuple, mixing.mix(rows, lanes=4).slots.collect()))
    empty = mixing.mix(rows.limit(0))
    assert empty.slots.count() == 0 and empty.rows.count() == 0


def test_mixed_documents_hold_the_taken_words(spark):
    docs = spark.sql("SELECT id AS doc_id, IF(id % 9 = 0, NULL, array_join(transform(sequence(0, 20 + cast(id * 7 % 150 AS INT)), i -> concat(id, '_', i)), '  ')) AS text, concat('s', id % 4) AS source, 0L AS n_chars, id AS epoch, id AS sid, id AS block, id AS words FROM range(80)")
    docs = docs.unionByName(docs.where("doc_id < 8"))
    mixture = mixing.mix(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    want = {r["doc_id"]: r["t"] for r in mixture.rows.join(mixture.taken(), ["sid", "row"]).groupBy("doc_id").agg(F.sum("taken").alias("t")).collect()}
    rows = mixing.mixed_documents(docs).collect()
    got = {}
    for r in rows:
        words = r["text"].split()
        numbers = [int(w.split("_")[1]) for w in words]
        assert all(w.startswith(f"{r['doc_id']}_") for w in words) and numbers == sorted(set(numbers)) and r["n_chars"] == len(r["text"])
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(words)
    assert got == want


def _undo(text: str) -> list[tuple[str, str]]:
    import re
    turns = re.findall(r"<\|(?!\|)(.*?)\|>(.*?)<\|end\|>", text, re.S)
    return [(role.replace("<||", "<|"), body.replace("<||", "<|")) for role, body in turns]


def test_preferences_round_trip_and_masks(spark):
    turns = [("user", "hi <|end|> there"), ("assistant", "a<"), ("user", ""), ("assistant", "good")]
    other = [*turns[:3], ("assistant", "bad"), ("user", "x"), ("assistant", None)]
    pairs = spark.createDataFrame([(1, turns, other, "keep"), (2, turns, turns, "k"), (3, None, other, None), (4, [], [], None)],
                                  "id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string")
    rows = {r["id"]: r for r in preferences.format_preferences(pairs).collect()}
    assert rows[1]["n_common"] == 3 and _undo(rows[1]["prompt"] + rows[1]["chosen_completion"]) == turns
    assert _undo(rows[1]["prompt"] + rows[1]["rejected_completion"]) == [(r, t or "") for r, t in other]
    masked = [rows[1]["rejected_completion"][s["start"]:s["end"]] for s in rows[1]["rejected_spans"]]
    assert masked == ["bad<|end|>", "<|end|>"]
    assert rows[2]["n_common"] == 4 and rows[2]["chosen_completion"] == rows[2]["rejected_completion"] == ""
    assert rows[3]["n_common"] == 0 and rows[3]["prompt"] == "" and rows[4]["chosen_spans"] == []


def test_rival_pairs_cover_odd_tables(spark):
    turns = spark.createDataFrame([(0, 0, "user", "q"), (0, 1, "assistant", "r"), (0, 1, "assistant", "r"), (1, 0, "user", "q"), (2, None, "assistant", None), (None, 0, "user", "z")],
                                  "conv_id long, turn long, role string, text string")
    rows = {r["conv_id"]: r for r in preferences.rival_pairs(turns).collect()}
    assert set(rows) == {0, 1, 2} and len(rows[0]["chosen"]) == 2 and len(rows[0]["rejected"]) == 1 and rows[1]["chosen"] == rows[1]["rejected"]
    assert preferences.rival_pairs(turns.limit(0)).count() == 0


def test_benchmark_sql_finds_windows_cut_by_the_end(spark, sf, tmp_path):
    import duckdb
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = []
    for share in (70, 76, 80, 85, 90, 100):
        for lead in (0, 7):
            rows += [(len(rows) + i, "own words first here before the item " * (lead > 0) + " ".join(t.split()[:max(5, len(t.split()) * share // 100)])) for i, t in enumerate(items)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "docs"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{sf}/benchmark.parquet'")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/docs/*.parquet')")
    hits = decontamination.contaminated(docs, spark.read.parquet(f"{sf}/benchmark.parquet"))
    found = hits.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "first_word", "n_words")
    assert found.where("similarity < 0.9").count() > 100
    assert compare_queries.compare(found, con, SQL["op2_benchmark_hits"]).startswith("ok")


CLASHING = ["score", "__score", "__b", "__w", "__bias", "__best", "__marks", "__windows", "__n", "__size", "__number", "__parts", "__k", "__d", "__t", "c0", "host_"]


def _clashing(df):
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def test_columns_of_any_name_stay(spark, sf):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    kept = corpus_pipeline.toxicity(spark, _clashing(docs), sf)
    assert kept.columns == [*docs.columns, *CLASHING] and {r["score"] for r in kept.select("score").distinct().collect()} == {"own score"}
    mixed = mixing.mixed_documents(_clashing(docs))
    assert sorted(tuple(r)[:5] for r in mixed.collect()) == sorted(map(tuple, mixing.mixed_documents(docs).collect()))
    assert all(mixed.where(F.col(c) != f"own {c}").isEmpty() for c in CLASHING)
    cut = suffixes.cut_repeats(_clashing(docs.select("doc_id", "text")))
    assert sorted((r["doc_id"], bytes(r["kept"])) for r in cut.collect()) == sorted((r["doc_id"], bytes(r["kept"])) for r in suffixes.cut_repeats(docs.select("doc_id", "text")).collect())
    assert {r["__marks"] for r in cut.collect()} == {"own __marks"}
    model, pages = urls.train_url_filter(urls.labelled_urls(spark)), spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").limit(40)
    names = [c for c in CLASHING if c != "score"]
    for inline in (1000, 1):
        judged = urls.judge_urls(_clashing(pages), urls.rule_table(spark), model, inline_rules=inline)
        assert {tuple(r[c] for c in names) for r in judged.collect()} == {tuple(f"own {c}" for c in names)}
        plain = urls.judge_urls(pages, urls.rule_table(spark), model, inline_rules=inline)
        assert sorted((r["page_id"], r["verdict"]) for r in judged.collect()) == sorted((r["page_id"], r["verdict"]) for r in plain.collect())


def test_urls_of_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(pages, urls.rule_table(spark), urls.train_url_filter(urls.labelled_urls(spark))).count() == 0
