"""Ingest, search, service and command line over a small library of EPUB, layout and text files."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from hybridloom.config import ChunkSettings, SearchSettings
from hybridloom.plans import cli, ingest
from hybridloom.plans.search import SearchEngine
from hybridloom.plans.service import Service
from hybridloom.schema import equality_filter as schema_filter
from hybridloom.sources import books, files, layouts, sidecar
from hybridloom.sources.store import CollectionStore, safe_name

WORDS = "retrieval fusion ranking vectors sparse dense planning agents memory tools evaluation judges".split()


def prose(seed: int, sentences: int) -> str:
    return " ".join(f"The {WORDS[(seed + i) % len(WORDS)]} part {i} explains {WORDS[(seed * 3 + i) % len(WORDS)]} in detail." for i in range(sentences))


def write_epub(path, title, chapters):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles>'
                   '<rootfile full-path="OEBPS/content.opf"/></rootfiles></container>')
        items = "".join(f'<item id="c{i}" href="c{i}.xhtml"/>' for i in range(len(chapters)))
        spine = "".join(f'<itemref idref="c{i}"/>' for i in range(len(chapters)))
        z.writestr("OEBPS/content.opf", '<package xmlns="http://www.idpf.org/2007/opf" xmlns:opf="http://www.idpf.org/2007/opf" xmlns:dc="http://purl.org/dc/elements/1.1/">'
                   f'<metadata><dc:title>{title}</dc:title><dc:creator>Ann Author</dc:creator><dc:language>en</dc:language>'
                   '<dc:identifier>urn:x</dc:identifier><dc:identifier opf:scheme="ISBN">978-1</dc:identifier></metadata>'
                   f'<manifest>{items}</manifest><spine>{spine}</spine></package>')
        for i, body in enumerate(chapters):
            z.writestr(f"OEBPS/c{i}.xhtml", f"<html><body>{body}</body></html>")


@pytest.fixture(scope="module")
def library(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("library")
    write_epub(folder / "one.epub", "Book One", ["", f"<h1>Fusion</h1><p>{prose(1, 30)}</p><h2>Ranking</h2><p>{prose(2, 30)}</p>",
                                                 f"<h1>Agents</h1><p>{prose(7, 40)}</p>"])
    write_epub(folder / "two.epub", "Book Two", [f"<p>{prose(4, 25)}</p>"])
    (folder / "two.epub.metadata.json").write_text(json.dumps({"metadataAttributes": ["publisher: Open Press", "title: Second Book"]}))
    (folder / "broken.epub").write_bytes(b"no zip")
    return str(folder)


@pytest.fixture(scope="module")
def engine(spark, library, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    args = cli.parser().parse_args(["--root", root, "ingest", "Books", library])
    report = cli.run(args, spark)
    assert report["collection"] == "books" and report["papers"] == 2
    store = CollectionStore(spark, root)
    ingest.ingest(store, "plain", store.read("books").select("source_file", F.col("section_title").alias("title"), F.col("text").alias("content"), "section_index",
                                                             "chapter_index", "publisher"), ChunkSettings(chunk_size=60, enable_semantic=False), sparse=None)
    return SearchEngine(spark, store, SearchSettings(collections=("books", "plain"), default_collection="books", top_k=3))


def test_epub_tables(spark, library):
    found = books.read_epubs(files.list_files(spark, library, ["epub"]))
    rows = {r["name"]: r for r in found.collect()}
    assert rows["broken.epub"]["error"] and rows["one.epub"]["isbn"] == "978-1" and rows["one.epub"]["creator"] == "Ann Author"
    sections = books.book_sections(sidecar.override(found, sidecar.read_sidecars(spark, library))).orderBy("name", "chapter_index", "section_index").collect()
    assert [(s["name"], s["chapter_index"], s["title"], s["heading_level"]) for s in sections] == [
        ("one.epub", 0, "Fusion", 1), ("one.epub", 0, "Ranking", 2), ("one.epub", 1, "Agents", 1), ("two.epub", 0, "(no title)", 0)]
    assert {s["publisher"] for s in sections if s["name"] == "two.epub"} == {"Open Press"}
    assert {s["book_title"] for s in sections} == {"Book One", "Second Book"}


def test_ingest_again_adds_nothing(spark, library, engine):
    before = {c: engine.store.read("books", c).count() for c in ("payload", "dense", "sparse")}
    cli.run(cli.parser().parse_args(["--root", engine.store.root, "ingest", "books", library]), spark)
    assert {c: engine.store.read("books", c).count() for c in before} == before
    assert before["payload"] == before["dense"] == before["sparse"]


def test_sequence_is_dense_per_file(engine):
    rows = engine.store.read("books").groupBy("source_file").agg(F.count("*").alias("n"), F.max("doc_chunk_seq").alias("m"), F.count_distinct("doc_chunk_seq").alias("d")).collect()
    assert all(r["n"] == r["m"] + 1 == r["d"] for r in rows)


def test_hybrid_search_finds_the_section(engine):
    found = engine.search("fusion ranking of retrieval", top_k=3)
    assert found["total_chunks"] == 3
    assert found["groups"][0]["best_score"] >= found["groups"][-1]["best_score"]
    assert "**Sources:**" in found["prompt_context"] and found["sources"][0]["source_id"] == 1


def test_dense_search_adds_context(engine):
    found = engine.search("agents and memory", top_k=1, collection="plain")
    assert found["total_chunks"] > 1


def test_filter_is_applied_before_ranking(engine):
    found = engine.search("fusion ranking", top_k=3, filter_by={"source_file": "two.epub"})
    assert found["total_chunks"] >= 1 and {c["source_file"] for g in found["groups"] for c in g["chunks"]} == {"two.epub"}


def test_cross_collection(engine):
    found = engine.search_collections("open press fusion", top_k=2)
    assert found["collections_queried"] == ["books", "plain"]
    assert found["total_chunks"] >= 3
    with pytest.raises(LookupError):
        engine.search_collections("x", collections=["missing"])


def test_context_by_title_and_by_meaning(engine):
    exact = engine.get_context("one.epub", section_title="Ranking", radius=1)
    assert exact["total_chunks"] >= 1 and exact["groups"][0]["chunks"][0]["score"] == 1.0
    meaning = engine.get_context("two.epub", section_title="(no title)", radius=1)
    assert meaning["total_chunks"] >= 1
    assert engine.get_context("absent.epub", query="x")["total_chunks"] == 0


def test_random_chunk_is_stable_and_grows(engine):
    a, b = (engine.pick_random_chunk("plain", min_tokens=10, min_total_tokens=150, seed=5) for _ in range(2))
    assert a == b and a["chunks_used"] > 1 and a["total_tokens"] >= 150
    assert "error" in engine.pick_random_chunk("plain", min_tokens=10_000)


def test_service_speaks_json_rpc(engine):
    service = Service(engine)
    assert service.handle({"jsonrpc": "2.0", "id": 1, "method": "initialize"})["result"]["protocolVersion"]
    assert len(service.handle({"jsonrpc": "2.0", "id": 1, "method": "tools/list"})["result"]["tools"]) == 6
    reply = service.handle({"jsonrpc": "2.0", "id": 2, "method": "tools/call", "params": {"name": "list_sources", "arguments": {"collection": "books", "limit": 1}}})
    body = json.loads(reply["result"]["content"][0]["text"])
    assert body["total"] == 2 and body["has_more"] and len(body["sources"]) == 1
    assert service.handle({"jsonrpc": "2.0", "id": 3, "method": "nope"})["error"]["code"] == -32601
    assert service.handle({"method": "list_books", "arguments": {"collection": "books"}})["result"]["books"][0]["book_title"] == "Book One"
    answer = service.query("fusion", mode="answer", collection="books", top_k=2)
    assert answer["answer"].startswith("[score:") and service.query("fusion", collection="books", filter_by="{bad", top_k=1)["total_chunks"] == 1


def test_partial_update_touches_one_component(spark, engine):
    store = engine.store
    name = store.create("update")
    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, text string")
    store.append(name, rows)
    store.append(name, rows.withColumn("dense", F.array(F.lit(1.0))).select("id", "dense"), "dense")
    store.replace(name, spark.createDataFrame([("a", [5.0])], "id string, dense array<double>"), "dense")
    assert {r["id"]: r["dense"] for r in store.read(name, "dense").collect()} == {"a": [5.0], "b": [1.0]}
    assert store.read(name).count() == 2
    report = store.patch(name, spark.createDataFrame([("a", "t")], "id string, title string"), ["id"], ["title"], dry_run=True) if "title" in store.read(name).columns else None
    assert report is None or report.first()["changed"] == 1
    with pytest.raises(PermissionError):
        CollectionStore(spark, store.root, frozenset({"Update"})).drop("update")
    assert safe_name("  My Böök/1 ") == "myböök1"


def test_papers_are_skipped_once_stored(spark, engine, tmp_path):
    span = lambda text: [{"type": "text", "content": text}]
    page = [{"type": "title", "content": {"title_content": span("Introduction"), "level": 1}}, {"type": "paragraph", "content": {"paragraph_content": span(prose(3, 20))}},
            {"type": "title", "content": {"title_content": span("References"), "level": 1}}, {"type": "paragraph", "content": {"paragraph_content": span("[1] x")}}]
    (tmp_path / "2603_00001" / "auto").mkdir(parents=True)
    (tmp_path / "2603_00001" / "auto" / "content_list_v2.json").write_text(json.dumps([page]))
    (tmp_path / "2603_00001_content_list_v2.json").write_text(json.dumps([page[:0]]))
    (tmp_path / "2603_00002_content_list_v2.json").write_text(json.dumps([page]))
    sections = layouts.sections(layouts.discover(spark, str(tmp_path)))
    assert sorted((r["arxiv_id"], r["title"]) for r in sections.collect()) == [("2603.00001", "Introduction"), ("2603.00002", "Introduction")]
    first = ingest.ingest_papers(engine.store, "papers", sections)
    again = ingest.ingest_papers(engine.store, "papers", sections)
    assert first == again and first["papers"] == 2
    ingest.derive_sparse_collection(engine.store, "papers", "papers-sparse")
    assert engine.store.read("papers-sparse").filter(F.size("dense_chunk_ids") == 1).count() >= 2
    assert {r["source_url"] for r in engine.store.read("papers-sparse").collect()} == {"https://arxiv.org/abs/2603.00001", "https://arxiv.org/abs/2603.00002"}


def test_multi_hop_never_repeats(engine):
    found = engine.multi_hop("fusion", "plain", 2, 3, lambda q, texts: texts[0])
    ids = [r["id"] for r in found.collect()]
    assert len(ids) == len(set(ids)) == 6
    hybrid = [r["id"] for r in engine.multi_hop("fusion", "books", 1, 2, lambda q, texts: texts[0], lambda asked, name, k: engine.hybrid_hits(asked, name, k)).collect()]
    assert len(hybrid) == len(set(hybrid)) == 2
    assert hybrid[:1] == [r["id"] for r in engine.hybrid_hits(engine.queries(["fusion"]), "books", 1).collect()]


def test_stored_batches_are_not_shuffled_by_id(spark, tmp_path, monkeypatch):
    from hybridloom.operators import dml
    from hybridloom.sources.store import CollectionStore
    store, plans, write = CollectionStore(spark, str(tmp_path / "c")), [], CollectionStore._batch
    name = store.create("words")
    frame = lambda *ids: spark.createDataFrame([(i, ([f"t{i}", "all"], [1.0, 2.0])) for i in ids], "id long, sparse struct<indices array<string>, values array<double>>")

    def seen(self, folder, component, rows, *args, **options):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, folder, component, rows, *args, **options)

    monkeypatch.setattr(CollectionStore, "_batch", seen)
    store.append(name, frame(1, 2, 3), "sparse")
    store.append(name, frame(3, 4, 5), "sparse")
    store.replace(name, frame(2, 5).withColumn("sparse", F.struct(F.array(F.lit("new")).alias("indices"), F.array(F.lit(1.0)).alias("values"))), "sparse")
    assert len(plans) == 3 and not any("Exchange hashpartitioning" in p for p in plans)
    store.append(name, frame(6, 6, 6, 1), "sparse")  # copies inside a batch
    assert sorted(r["id"] for r in store.read(name, "sparse").collect()) == [1, 2, 3, 4, 5, 6]
    counts = {r["term"]: r["df"] for r in store.term_statistics(name).collect()}
    assert counts == {None: 6, "new": 2, "all": 4, "t1": 1, "t3": 1, "t4": 1, "t6": 1}

    rows = spark.range(5000).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("id"), F.col("id").cast("string").alias("text"))
    listed = spark.range(0, 9000, 3)
    for made, how in ((dml.without(rows, listed, "id", 10), "left_anti"), (dml.within(rows, listed, "id", 10), "left_semi")):
        assert sorted(map(str, made.collect())) == sorted(map(str, rows.join(listed, "id", how).collect()))


def test_changed_files_replace_their_chunks_and_vectors(spark, tmp_path):
    from hybridloom.plans.ingest import ingest
    from hybridloom.sources.store import CollectionStore
    store = CollectionStore(spark, str(tmp_path / "c"))
    section = lambda file, text: (file, "T", text, 0)
    frame = lambda rows: spark.createDataFrame(rows, "source_file string, title string, content string, section_index int")
    ingest(store, "books", frame([section("a.epub", "The old words of a. " * 5), section("b.epub", "The words of b stay. " * 5)]))
    ingest(store, "books", frame([section("a.epub", "Entirely new words. " * 5)]))
    texts = {r["source_file"]: r["text"] for r in store.read("books").collect()}
    assert "new words" in texts["a.epub"] and "of b stay" in texts["b.epub"] and store.read("books").filter("text LIKE '%old words%'").isEmpty()
    ids = {r["id"] for r in store.read("books").collect()}
    assert {r["id"] for r in store.read("books", "dense").collect()} == {r["id"] for r in store.read("books", "sparse").collect()} == ids


def test_ingest_takes_books_and_papers_by_extension(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "2401.00001.pdf").write_bytes(b"no pdf at all")
    (folder / "2401.00002.pdf").write_bytes(b"scanned pages")
    (folder / "notes.txt").write_text("ignored")
    block = {"type": "paragraph", "content": {"paragraph_content": [{"type": "text", "content": "Tides move the mill wheel twice a day. " * 6}]}}
    title = {"type": "title", "content": {"title_content": [{"type": "text", "content": "Tides"}], "level": 1}}
    (folder / "2401.00002_content_list_v2.json").write_text(json.dumps([[title, block]]))
    report = cli.run(cli.parser().parse_args(["--root", str(tmp_path / "c"), "ingest", "mixed", str(folder)]), spark)
    from hybridloom.sources.store import CollectionStore
    rows = CollectionStore(spark, str(tmp_path / "c")).read("mixed").collect()
    assert report["unreadable_files"] == 1 and {r["source_file"] for r in rows} == {"2401.00002.pdf"} and "mill wheel" in rows[0]["text"]


def _store(spark, tmp_path):
    return CollectionStore(spark, str(tmp_path / "c"))


def test_owners_keep_their_folder_in_every_call(spark, tmp_path):
    store = _store(spark, tmp_path)
    rows = spark.createDataFrame([("a", "x")], "id string, text string")
    store.append(store.create("my docs"), rows)
    assert store.create(" My Docs") == "mydocs" and store.names() == ["mydocs"] and store.read("MY DOCS").count() == store.read("mydocs").count() == 1
    with pytest.raises(ValueError):
        store.create("mydocs")
    for call in (store.create, store.drop, store.read, store.snapshot, lambda n: store.append(n, rows), lambda n: store.replace(n, rows, "payload"), lambda n: store.has(n, "dense")):
        for other in ("m y d o c s", "my/docs"):
            with pytest.raises(ValueError):
                call(other)
    assert store.read("my docs").count() == 1


def test_writers_that_meet_lose_nothing(spark, tmp_path):
    store = _store(spark, tmp_path)
    name = store.create("shared")
    frame = lambda ids: spark.createDataFrame([(i, f"text {i}", "f") for i in ids], "id string, text string, source_file string")
    store.append(name, frame("ab"))
    before = store.snapshot(name)
    reader = store.read(name)
    log, put, met = store._log(name), type(store._log(name)).put, []

    def late(self, number, entry):  # another writer commits b, c, d between this one's reading and its commit
        if not met:
            met.append(number)
            store.append(name, frame("bcd"))
        return put(self, number, entry)

    type(log).put = late
    try:
        store.append(name, frame("cde"))
    finally:
        type(log).put = put
    assert sorted(r["id"] for r in store.read(name).collect()) == list("abcde") and store.snapshot(name).version == before.version + 2
    assert sorted(r["id"] for r in reader.collect()) == ["a", "b"] == sorted(r["id"] for r in store.read(name, at=before).collect())
    assert not store._log(name).put(before.version, {"changes": []})
    met.clear()
    type(log).put = lambda self, number, entry: (met.append(number) or store.append(name, frame("f"))) and False or put(self, number, entry) if not met else put(self, number, entry)
    try:
        store.replace(name, frame("a").withColumn("text", F.lit("new")), "payload")
    finally:
        type(log).put = put
    texts = {r["id"]: r["text"] for r in store.read(name).collect()}
    assert set(texts) == set("abcdef") and texts["a"] == "new" and texts["f"] == "text f"
    store.append(name, frame("g"))
    store.compact(name, "payload")
    assert len(store.snapshot(name).batches["payload"]) == 1 and store.read(name).count() == 7
    assert store.vacuum(name) > 0 and store.read(name).count() == 7


def test_log_summaries_tell_the_same(spark, tmp_path, monkeypatch):
    from hybridloom.sources.commits import CommitLog
    monkeypatch.setattr(CommitLog, "STEP", 2)
    store = _store(spark, tmp_path)
    name = store.create("many")
    for i in range(5):
        store.append(name, spark.createDataFrame([(str(i), [float(i)])], "id string, dense array<double>"), "dense")
    assert store.snapshot(name).version == 6 and len(store._log(name)._numbers("summary")) == 3 and store._log(name).entries()[1] == []
    assert sorted(r["id"] for r in store.read(name, "dense").collect()) == list("01234")


def test_collections_of_given_components(spark, tmp_path):
    store = _store(spark, tmp_path)
    sparse_only = store.create("terms", components=("payload", "sparse"))
    sized = store.create("sized", dense_size=2)
    vectors = spark.createDataFrame([("a", [1.0])], "id string, dense array<double>")
    for name in (sparse_only, sized):
        with pytest.raises(ValueError):
            store.append(name, vectors, "dense")
    store.append(sized, spark.createDataFrame([("a", [1.0, 2.0])], "id string, dense array<double>"), "dense")
    assert store.read(sized, "dense").count() == 1 and not store.has(sparse_only, "dense")


def test_statistics_equal_a_recount(spark, tmp_path):
    from hybridloom.operators import postings, topk
    store = _store(spark, tmp_path)
    name = store.create("counted")
    vector = lambda words: (words, [1.0] * len(words))
    frame = lambda rows: spark.createDataFrame([(i, vector(w)) for i, w in rows], "id string, sparse struct<indices array<string>, values array<double>>")

    def agrees():
        held = store.read(name, "sparse")
        kept = {r["term"]: r["idf"] for r in postings.idf_of(store.term_statistics(name)).collect()}
        assert kept == pytest.approx({r["term"]: r["idf"] for r in topk.inverse_document_frequency(held).collect()})

    store.append(name, frame([("1", ["a", "b"]), ("2", ["b"]), ("3", [])]), "sparse")
    agrees()
    store.append(name, frame([("2", ["z"]), ("4", ["b", "c"])]), "sparse")
    agrees()
    store.replace(name, frame([("1", ["c"]), ("9", ["d", "a"])]), "sparse")
    agrees()
    store.append(name, spark.createDataFrame([("1", "f"), ("4", "f"), ("9", "g")], "id string, source_file string"))
    store.retire(name, spark.createDataFrame([("4", "f")], "id string, source_file string"))
    agrees()
    assert {r["id"] for r in store.read(name, "sparse").collect()} == {"2", "3", "4", "9"}
    store.append(name, frame([("5", ["b"])]), "sparse")
    store.compact(name, "sparse")
    agrees()
    assert store.term_statistics(name).where("term IS NULL").first()["df"] == 5


def test_posting_lists_find_what_a_scan_finds(spark, tmp_path):
    from hybridloom.operators import postings, topk
    rng = random.Random(4)
    terms = [f"t{i}" for i in range(60)]

    def vector(size):
        chosen = rng.sample(terms[:1 + int(59 * rng.random() ** 2)] + terms[:1], 1) if size == 1 else sorted(set(rng.choices(terms, weights=range(60, 0, -1), k=size)))
        return chosen, [round(rng.random() * size / 4, 3) for _ in chosen]

    schema = "id long, sparse struct<indices array<string>, values array<double>>"
    points = [(i, vector(rng.choice([1, 2, 5, 20]))) for i in range(1500)] + [(5000 + i, (["t0"], [0.5])) for i in range(300)] + [(9000, ([], [])), (9001, None)]
    queries = spark.createDataFrame([(q, vector(4)) for q in range(12)] + [(50, (["unknown"], [1.0])), (51, ([], []))], "query_id long, sparse struct<indices array<string>, values array<double>>")
    df = spark.createDataFrame(points, schema)
    store = _store(spark, tmp_path)
    name = store.create("posted")
    for part in ("id % 2 = 0", "id % 2 = 1"):
        store.append(name, df.where(part), "sparse")
    assert store.sparse_postings(name) is None
    store.index_sparse(name, block_points=16)
    idf = postings.idf_of(store.term_statistics(name))
    want = {(r["query_id"], r["rn"], r["id"], r["score"]) for r in topk.sparse_topk(df, queries, 5).collect()}
    for pilot in (1, 4):
        search = postings.PostingsSearch(store.sparse_postings(name), postings.query_terms(queries, idf), 5, pilot=pilot)
        assert {(r["query_id"], r["rn"], r["id"], r["score"]) for r in search.hits().collect()} == want
        report = search.report().collect()
        assert {r["query_id"] for r in report} == {q for q, *_ in want} and all(0 < r["scored"] <= r["blocks"] for r in report)
        assert sum(r["scored"] for r in report) < 0.7 * sum(r["blocks"] for r in report)
    allowed = df.where("id % 3 = 0").select("id")
    limited = {(r["query_id"], r["rn"], r["id"]) for r in topk.sparse_topk(df.join(allowed, "id"), queries, 5, idf=idf).collect()}
    assert {(r["query_id"], r["rn"], r["id"]) for r in postings.postings_topk(store.sparse_postings(name), queries, 5, idf, allowed=allowed).collect()} == limited
    scanned = search.postings.select("term", "top")
    assert len(scanned.inputFiles()) > 0 and "PartitionFilters: [isnotnull(bucket" in scanned._jdf.queryExecution().toString() or "bucket" in scanned._jdf.queryExecution().executedPlan().toString()
    store.replace(name, df.where("id = 1"), "sparse")
    assert store.sparse_postings(name) is None  # a new batch has no lists yet


def test_filtered_reads_open_only_files_that_may_match(spark, tmp_path, monkeypatch):
    from hybridloom.sources import sketches
    monkeypatch.setattr(sketches, "clustered", lambda rows, plain=sketches.clustered: plain(rows, files=16))
    store = _store(spark, tmp_path)
    name = store.create("filed")
    rows = spark.range(3000).selectExpr("md5(cast(id as string)) AS id", "concat('file-', id % 40) AS source_file", "if(id % 5 = 0, NULL, concat('l', id % 3)) AS language", "id AS number")
    store.append(name, rows)
    everything = len(store.read(name).inputFiles())
    assert everything >= 12
    for asked in ({"source_file": "file-7"}, {"source_file": ["file-7", "file-9"], "language": "l1"}, {"id": rows.first()["id"]}, {"source_file": "file-7", "number": {"gte": 100}},
                  {"source_file": {"gte": "file-38", "lt": "file-4"}}, {"language": "none"}, {"number": 7}, {"source_file": []}):
        got = store.read(name, filter_by=asked)
        want = schema_filter(rows, asked)
        assert sorted(r["number"] for r in got.collect()) == sorted(r["number"] for r in want.collect())
        if asked.get("source_file") == "file-7" or "id" in asked:
            assert len(got.inputFiles()) <= everything / 2
    assert store.read(name, filter_by={"language": "none"}).inputFiles() == []


def test_library_source_feeds_ingest(spark, tmp_path):
    from hybridloom.sources import library
    from hybridloom.streaming import incremental
    library.register(spark)
    folder = tmp_path / "files"
    folder.mkdir()
    write_epub(folder / "one.epub", "Book One", [f"<h1>Start</h1><p>{prose(1, 20)}</p>"])
    (folder / "bad.epub").write_bytes(b"no archive")
    (folder / "one.epub.metadata.json").write_text("{}")
    span = [{"type": "text", "content": "Tides move the mill wheel twice a day. " * 6}]
    page = [{"type": "title", "content": {"title_content": [{"type": "text", "content": "Tides"}], "level": 1}}, {"type": "paragraph", "content": {"paragraph_content": span}}]
    (folder / "2401.00002_content_list_v2.json").write_text(json.dumps([page]))
    rows = {r["name"]: r for r in spark.read.format("library").option("bytesPerTask", "10").load(str(folder)).collect()}
    assert set(rows) == {"one.epub", "bad.epub", "2401.00002_content_list_v2.json"} and rows["one.epub"]["title"] == "Book One"
    assert rows["bad.epub"]["error"] and rows["one.epub"]["error"] is None and rows["2401.00002_content_list_v2.json"]["kind"] == "layout"
    assert spark.read.format("library").option("bytesPerTask", "10").load(str(folder)).rdd.getNumPartitions() == 3
    narrow = spark.read.format("library").option("bytesPerTask", "10").option("kind", "layout").load(str(folder)).filter("size > 0")
    assert [r["name"] for r in narrow.collect()] == ["2401.00002_content_list_v2.json"] and narrow.rdd.getNumPartitions() == 1
    assert spark.read.format("library").option("nameGlob", "one*").load(str(folder)).count() == 1 and spark.read.format("library").option("kind", "pdf").load(str(folder)).count() == 0
    store = CollectionStore(spark, str(tmp_path / "c"))
    report = ingest.ingest(store, "library", library.sections(spark.read.format("library").load(str(folder))))
    assert report["chunks"] > 1 and {r["doc_type"] for r in store.read("library").collect()} == {"book", "paper"}
    target = str(tmp_path / "seen")
    run = lambda: incremental.run_available(spark.readStream.format("library").load(str(folder)).select("name", "size", "kind"), str(tmp_path / "state"),
                                            incremental.append_once(target, ["name", "size"]))
    run()
    assert incremental.read_once(spark, target).count() == 3
    (folder / "two.json").write_text("[]")
    run()
    assert {r["name"] for r in incremental.read_once(spark, target).collect()} == {*rows, "two.json"} and incremental.OnceTable(spark, target, []).state().done != {}
    (folder / "notes.txt").write_text("plain")
    with pytest.raises(Exception, match="unsupported file type: .*notes.txt"):
        spark.read.format("library").load(str(folder)).count()
    assert spark.read.format("library").option("unknown", "ignore").load(str(folder)).count() == 4


def test_retrievals_are_read_by_name(spark, tmp_path):
    from hybridloom.sources import artifacts
    body = {"prompt_text": "q", "topk": 2, "dense_raw": [{"id": 4, "score": 0.5}], "merged": [{"rank": 1, "id": 4, "source": "dense", "score": 0.5, "text": "t"}, {"rank": 2, "id": "x", "source": "sparse"}]}
    (tmp_path / "prompt_003_sk_2.json").write_text(json.dumps(body))
    (tmp_path / "prompt_004_sk_0.json").write_text(json.dumps({"prompt_index": 9, "sparse_k": 5}))
    rows = {r["file"]: r for r in artifacts.read_retrievals(spark, str(tmp_path)).collect()}
    assert (rows["prompt_003_sk_2.json"]["prompt_index"], rows["prompt_003_sk_2.json"]["sparse_k"]) == (3, 2) and rows["prompt_004_sk_0.json"]["prompt_index"] == 9
    chunks = artifacts.retrieved_chunks(artifacts.read_retrievals(spark, str(tmp_path))).collect()
    assert [(c["prompt_index"], c["rank"], c["id"]) for c in chunks] == [(3, 1, "4"), (3, 2, "x")]
    artifacts.write_json(spark.createDataFrame([(1, "a")], "n int, s string"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).collect()[0]["s"] == "a"
    artifacts.write_report_csv(spark.range(3), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 3 and len(list((tmp_path / "csv").glob("*.csv"))) == 1


def test_fan_out_shows_every_prompt_and_source(spark):
    from hybridloom.plans.fanout import Source, fan_out
    prompts = spark.createDataFrame([(1,), (2,)], "query_id long")
    hits = spark.createDataFrame([(1, i, f"t{i}") for i in range(1, 9)], "query_id long, rn int, text string")
    seen = []
    search = lambda asked, k: seen.append(k) or hits.where(F.col("rn") <= k)
    rows = fan_out(prompts, [Source("a", search), Source("b", search, 2), Source("c", search, 2, shown=1)], 3).collect()
    count = lambda q, s: [(r["rank"], r["text"], r["total_results"]) for r in sorted(rows, key=lambda r: r["rank"]) if (r["query_id"], r["source"]) == (q, s)]
    assert seen == [3, 6, 6] and len(count(1, "a")) == 3 and len(count(1, "b")) == 6 and [c[2] for c in count(1, "c")] == [6, 6, 6]
    assert count(2, "a") == [(0, None, 0)] and all(r["lookup_time"] >= 0 and r["type"] == "TEXT" for r in rows)
