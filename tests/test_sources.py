import json

import pytest
from pyspark.sql import functions as F

from hybridloom.operators import evaluation as ev, models
from hybridloom.sources import artifacts, books, files, sidecar
from hybridloom.streaming import incremental


def test_prompts_in_every_form(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# comment\n\n first \nsecond\n")
    (tmp_path / "b.json").write_text(json.dumps(["x", "y", "z"]))
    (tmp_path / "c.json").write_text(json.dumps({"prompts": ["only"]}))
    read = lambda name, n=None: [tuple(r) for r in files.prompts(spark, str(tmp_path / name), n).orderBy("prompt_index").collect()]
    assert read("a.txt") == [(1, "first"), (2, "second")] and read("b.json", 2) == [(1, "x"), (2, "y")] and read("c.json") == [(1, "only")]


def test_sidecar_forms_agree(spark):
    rows = spark.createDataFrame([('{"metadataAttributes": {"title": "A: B", "isbn": "1"}}',), ('{"metadataAttributes": ["title: A: B", "isbn:1", "junk"]}',), ("broken",)], "v string")
    got = [r["m"] for r in rows.select(sidecar.attributes(F.col("v")).alias("m")).collect()]
    assert got == [{"title": "A: B", "isbn": "1"}] * 2 + [{}]


def test_file_names(spark):
    d = spark.range(1).select(files.assessment_dimensions(F.lit("12_spatial_orientation_1_8.json")).alias("d")).first()["d"]
    assert tuple(d) == (12, "spatial_orientation", 1, 8)
    names = spark.createDataFrame([("10_b.json",), ("2_a.json",), ("x.json",)], "n string")
    assert [r["n"] for r in names.orderBy(*files.numeric_prefix_order(F.col("n"))).collect()] == ["2_a.json", "10_b.json", "x.json"]
    assert files.loader_for("a.EPUB") == "epub"
    with pytest.raises(ValueError):
        files.loader_for("a.docx")


def test_arxiv_ids(spark):
    md = spark.createDataFrame([("c", "s1", "https://arxiv.org/abs/2603.07444 and https://arxiv.org/pdf/2603.07444"), ("c", "s2", "arxiv.org/abs/2603.07444")], "category string, subcategory string, value string")
    assert [tuple(r) for r in files.arxiv_ids(md).collect()] == [("c", "2603.07444", ["s1", "s2"])]


def test_critiques_old_and_new(spark, tmp_path):
    judged = {"raw": "", "parsed": {"chunks": [{"id": "a", "relevance": 4}, {"id": "b", "relevance": 60}], "reply": "r", "satisfaction": 8}, "parse_ok": True}
    base = {"prompt_index": 1, "sparse_k": 1, "sparse_fraction": "0.5", "sparse_collection": "x"}
    new = {**base, "chunks": [{"docket_id": "a", "source": "dense", "sources": ["dense", "sparse_resolved"]}, {"docket_id": "b", "source": "sparse_resolved"}], "judge_outputs": [judged, {"parse_ok": False}]}
    old = {**base, "chunks": [{"judge_id": "a", "source": "dense"}, {"judge_id": "b", "source": "sparse"}], "judge_output": judged}
    (tmp_path / "prompt_003_sk_2_control.json").write_text(json.dumps(new))
    (tmp_path / "prompt_003_sk_2_variable.json").write_text(json.dumps(old))
    rows = artifacts.case_of(artifacts.read_critiques(spark, str(tmp_path)))
    got = {r["tag"]: r for r in ev.critique_metrics(rows).collect()}
    for r in got.values():
        assert (r["prompt_index"], r["satisfaction"], r["avg_relevance"]) == (3, 8.0, 4.0)
        assert r["sparse_mass"] == pytest.approx(0.6) and r["dense_mass"] == pytest.approx(0.04) and r["sparse_lift"] == pytest.approx(1.2)
    assert got["control"]["relevance_sparse"] == 4.0 and got["variable"]["relevance_sparse"] is None


def test_verdict_file(spark, tmp_path):
    (tmp_path / "v.json").write_text(json.dumps({"1:0": "0", "1:1": 0.75, "2:0": None, "2:1": "bad"}))
    got = {r["key"]: r["verdict"] for r in artifacts.read_verdicts(spark, str(tmp_path / "v.json")).collect()}
    assert got == {"1:0": 0.0, "1:1": 0.75, "2:0": None, "2:1": None}


def test_backends_fall_through(spark):
    make = lambda rows: spark.createDataFrame(rows, "name string, text string, error string")
    done = books.first_success([make([("a", "x", None), ("b", None, "bad")]), make([("a", "second", None), ("b", "y", None), ("c", None, "bad")])])
    assert sorted((r["name"], r["text"]) for r in done.collect()) == [("a", "x"), ("b", "y")]


def test_model_calls_keep_going(spark):
    def model(text):
        if text == "bad":
            raise RuntimeError("down")
        return text.upper()
    rows = spark.createDataFrame([("ok",), ("bad",)], "t string")
    got = {r["t"]: r["m"] for r in models.call_model(rows, ["t"], model, "m", retries=1, pause=0.0).collect()}
    assert got["ok"]["reply"] == "OK" and got["bad"]["reply"] is None and got["bad"]["error"] == "down"
    asked: list[str] = []

    def flaky(text, sample):
        asked.append(text)
        return "{}" if len(asked) % 2 else "junk"

    twice = models.with_samples(rows.limit(1), 2)
    replies_ = [r["m"] for r in models.call_model(twice, ["t", "sample"], flaky, "m", retries=1, pause=0.0, accept=lambda r: r == "{}").collect()]
    assert len(replies_) == 2 and all(m["error"] is None or m["error"] == "reply not accepted" for m in replies_)
    parsed = spark.createDataFrame([('{"query": "Why?", "query_type": "numeric_fact_lookup"}',), ('{"query": "Why?", "query_type": "odd"}',), ('\n"plain words"\nmore',)], "r string")
    out = [tuple(r["q"]) for r in parsed.select(models.generated_query(F.col("r")).alias("q")).collect()]
    assert out == [("Why?", "numeric_fact_lookup", "trivia"), ("Why?", "odd", "operational"), ("plain words", "unknown", "operational")]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    handle = incremental.append_once(str(tmp_path / "t"), ["id"])
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "id int")
    handle(frame([1, 2, 2]), 0)
    handle(frame([2, 3]), 1)
    handle(frame([2, 3]), 1)
    assert sorted(r["id"] for r in incremental.read_once(spark, str(tmp_path / "t")).collect()) == [1, 2, 3]


def test_streams_do_not_erase_each_other(spark, tmp_path):
    """Two streams into one target, each numbering its batches from 0."""
    target = str(tmp_path / "t")
    for name, ids in (("a", range(0, 5)), ("b", range(3, 9))):
        spark.createDataFrame([(i,) for i in ids], "id long").write.parquet(str(tmp_path / name))
        stream = incremental.file_stream(spark, str(tmp_path / name), "id long")
        incremental.run_available(stream, str(tmp_path / f"state-{name}"), incremental.append_once(target, ["id"]))
    assert sorted(r["id"] for r in incremental.read_once(spark, target).collect()) == list(range(9))


def test_tables_of_part_files_are_ingested(spark, tmp_path):
    from hybridloom.workload.stream_queries import events_stream, incremental_ingest
    for name in ("documents", "events"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for query in (incremental_ingest, events_stream):
        whole = query(spark, "/root/testdata/sf0.001").collect()
        assert whole and sorted(query(spark, str(tmp_path)).collect()) == sorted(whole)
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert incremental_ingest(spark, str(tmp_path / "none")).collect() == []


def test_batches_open_no_more_files_as_the_history_grows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "BUCKETS", 4)
    monkeypatch.setattr(incremental, "MERGED", 3)
    table = incremental.OnceTable(spark, str(tmp_path / "t"), ["id", "part"])
    frame = lambda ids: spark.createDataFrame([(i, "p", 2) for i in ids], "id long, part string, value long")
    opened = []
    for n in range(11):
        assert table.append(frame([*range(n * 40, n * 40 + 40), None]), "s", n)
        opened.append(table.opened)
    assert not table.append(frame([1, 5000]), "s", 10) and table.append(frame([]), "s", 11)
    assert max(opened[1:]) <= 4 and len(table.state().segments) <= 5 and max(s["level"] for s in table.state().segments) == 2
    table.append(frame([0, 39, 200, 439, 440]), "other", 0)
    rows = table.read().collect()
    assert sorted(r["id"] for r in rows if r["id"] is not None) == list(range(441)) and len(rows) == 442


def test_streams_that_meet_store_an_id_once(spark, tmp_path):
    target = str(tmp_path / "t")
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "id long")
    first, put, met = incremental.OnceTable(spark, target, ["id"]), type(incremental.OnceTable(spark, target, ["id"]).log).put, []

    def late(self, number, entry):
        if not met:
            met.append(number)
            incremental.OnceTable(spark, target, ["id"]).append(frame([2, 3, 4]), "b", 0)
        return put(self, number, entry)

    type(first.log).put = late
    try:
        assert first.append(frame([1, 2, 3]), "a", 0)
    finally:
        type(first.log).put = put
    assert sorted(r["id"] for r in first.read().collect()) == [1, 2, 3, 4] and first.state().done == {"a": 0, "b": 0}
