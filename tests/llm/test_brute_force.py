"""Operators without SQL against brute force, fixed cases and held-out rows; odd tables for all."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hybridloom.llm import decontamination, minhash, neighbours, suffixes, templates, toxicity

ODD = "doc_id long, text string, lang string, source string, n_chars long"


def _texts(seed: int, n: int, words: int) -> list[str]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    return [" ".join(rng.choices(vocabulary, k=rng.randint(1, words))) for _ in range(n)]


def _odd_rows() -> list[tuple]:
    texts = _texts(1, 25, 120)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i], "en", None, 1) for i in range(5)] + [(100, texts[0], "en", None, 1)] * 2
    rows += [(200 + i, texts[9] + f" tail{i}", "de", "s", 1) for i in range(6)]
    rows += [(300, None, None, None, None), (301, "", "x", "s", 0), (302, " \t\n", "x", "s", 3), (None, texts[3], None, "s", 1), (None, None, None, None, None)]
    rows += [(303, "x" * 1500, "en", "s", 1500), (304, "ab" * 800, "en", "s", 1600), (7, "another text under a used id " * 5, "en", "s", 1), (305, " ".join(_texts(2, 60, 200)), "en", "s", 1)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(_odd_rows(), ODD).withColumn("Kept", F.lit("extra"))


def _repeats(rows: list[tuple[int | None, str | None]]) -> dict:
    """What suffixes.cut_repeats promises, with a set of windows."""
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    keyed = sorted({((2 ** 63 - 1) if d is None else d, int(sha(t)[:8], 16), t or "") for d, t in rows})
    seen, out = set(), {}
    for d, key, text in keyed:
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            if data[p:p + 100] in seen:
                gone[p:p + 100] = True
            seen.add(data[p:p + 100])
        out[d, key] = (len(data), int(gone.sum()), bytes(np.frombuffer(data, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("hot, rivals", [(64, 30_000), (2, 30_000), (2, 1)])
def test_repeated_bytes(spark, odd, monkeypatch, hot, rivals):
    monkeypatch.setattr(suffixes, "HOT_COUNT", hot)
    monkeypatch.setattr(suffixes, "MOST_RIVALS", rivals)
    monkeypatch.setattr(suffixes, "BUCKET_SPANS", 20)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 4000)
    want = _repeats([(r[0], r[1]) for r in _odd_rows()])
    rows = suffixes.cut_repeats(odd).collect()
    assert len(rows) == len(_odd_rows())
    for r in rows:
        key = ((2 ** 63 - 1) if r["doc_id"] is None else r["doc_id"], int(hashlib.sha256((r["text"] or "").encode()).hexdigest()[:8], 16))
        assert (r["n_bytes"], r["n_removed"], bytes(r["kept"])) == want[key]


@pytest.mark.parametrize("hot", [64, 2])
def test_repeated_rows_with_near_copies(spark, monkeypatch, hot):
    """Repeated originals, with and without an id, that edited copies elsewhere give anchors of several runs."""
    monkeypatch.setattr(suffixes, "HOT_COUNT", hot)
    rows = []
    for i, text in enumerate(t for t in _texts(11, 30, 150) if len(t) > 400):
        near = text[:len(text) // 2] + "#" + text[len(text) // 2 + 1:]
        d = None if i % 3 == 0 else i
        rows += [(d, text)] * 3 + [(1000 + i, near)] * (1 + i % 2)
    want = _repeats(rows)
    got = suffixes.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        key = ((2 ** 63 - 1) if r["doc_id"] is None else r["doc_id"], int(hashlib.sha256(r["text"].encode()).hexdigest()[:8], 16))
        assert (r["n_bytes"], r["n_removed"], bytes(r["kept"])) == want[key]


def test_repeated_bytes_over_pieces(monkeypatch):
    data = np.frombuffer(" ".join(_texts(5, 40, 100)).encode(), np.uint8)
    whole = suffixes.spans(data)
    monkeypatch.setattr(suffixes, "_PIECE", 777)
    pieces = suffixes.spans(data)
    assert whole[3].sum() == pieces[3].sum() == len(data) - 99
    assert np.array_equal(np.repeat(whole[1], whole[3]), np.repeat(pieces[1], pieces[3]))


def test_slots_of_runs_are_even():
    hashed = suffixes.spans(np.random.default_rng(7).integers(0, 256, 4 << 20).astype(np.uint8))[0]
    slot, key = suffixes._dealt(hashed, 20_000)
    assert len(hashed) > 100_000 and np.bincount(slot.astype(np.int64)).max() < 8 * len(hashed) / 20_000
    assert len(np.unique(slot << np.uint64(32) | key)) == len(np.unique(hashed))


def test_repeated_bytes_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {d: (n, gone, hashlib.sha256(kept).hexdigest()) for (d, _), (n, gone, kept) in _repeats([(r[0], r[1]) for r in docs]).items()}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in suffixes.op5_repeated_bytes(spark, sf).collect()}
    assert got == want


def _sets(text: str | None) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("block", [2048, 3])
def test_near_duplicate_components(spark, odd, block):
    rows = [r for r in _odd_rows() if r[0] is not None]
    sets = [_sets(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append(r[0])
    want = sorted((r[0], len(sets[i]), min(groups[root(i)])) for i, r in enumerate(rows))
    got = minhash.near_duplicates(odd, block=block).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == want
    assert len(got) == len(_odd_rows()) and all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)


def test_super_minhash_estimates_and_chains(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 3000).astype(np.uint64)
    for size in (1, 7, 60, 1500):
        a, b = np.unique(base[:size]), np.unique(base[size // 4:size + size // 4])
        one, two = minhash.super_minhash([a, b])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((one == two).mean() - true) < 0.17 and (minhash.super_minhash([a])[0] == one).all()
    chain = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(60)] + [(b"\xf0", b"\xf1")], "a binary, b binary").repartition(5)
    roots = {bytes(r["node"]): bytes(r["root"]) for r in minhash.components(chain).collect()}
    assert len(roots) == 63 and all(v == (b"\xf0" if k[0] >= 0xF0 else b"\0") for k, v in roots.items())


def test_many_unlinked_neighbours_stay_apart(spark):
    """Texts that share much with one another, below the threshold, and a few that link."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[:60] + [f"u{i}_{k}" for k in range(20 + rng.randint(0, 8))]), "en", "s", 1) for i in range(120)]
    rows += [(500 + i, rows[i][1] + " more", "en", "s", 1) for i in range(10)]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, ODD), block=16).collect()}
    assert got == {r[0]: r[0] - 500 if r[0] >= 500 else r[0] for r in rows}


def test_decontamination_finds_edited_passages_and_leaves_others(spark):
    items = _texts(8, 12, 60)[:12]
    items = [t if len(t.split()) >= 30 else t + " " + " ".join(_texts(9, 1, 1)) + " filler words to reach a length that an edit leaves near enough to find " * 2 for t in items]
    rng = random.Random(6)
    docs, want = [], set()
    for i, item in enumerate(items):
        words = item.split()
        edited = words[:]
        edited[len(words) // 2] = "changed"
        docs.append((i, "before it " + " ".join(words).upper() + "! after", "en", "s", 1))
        docs.append((100 + i, " ".join(_texts(i, 1, 50)) + " " + ", ".join(edited), "en", "s", 1))
        docs.append((200 + i, " ".join(words[: len(words) // 2]) + " " + " ".join(rng.choices(["other", "thing", "else", "now"], k=30)), "en", "s", 1))
        want.add((i, i))
        a, b = (Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4)) for w in (words, edited))
        if (a & b).total() / (a | b).total() >= 0.75:
            want.add((100 + i, i))
    docs += [(900, None, None, None, None), (901, "", None, None, None), (902, "w " * 3000, None, None, None)]
    frame = spark.createDataFrame(docs, ODD).withColumn("item_id", F.lit(0))
    bench = spark.createDataFrame([*enumerate(items), (50, None), (51, ""), (52, "too few words")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(frame, bench).collect()}
    assert got >= want and all(d < 200 for d, _ in got)
    left = decontamination.decontaminate(frame, bench)
    assert left.columns == frame.columns and left.count() == len(docs) - len({d for d, _ in got})
    assert decontamination.decontaminate(frame.limit(0), bench).count() == 0 and decontamination.decontaminate(frame, bench.limit(0)).count() == len(docs)


def _best_windows(text: str, item: str) -> tuple[float, int] | None:
    """(similarity, first word) of the best window as decontamination.contaminated promises it, over all starts."""
    words, wanted = ([w.lower() for w in re.findall(r"[^\W_]+", t)] for t in (text, item))
    count = lambda w: Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    b, best = count(wanted), (0.0, 0)
    for s in range(max(1, len(words) - 4)):
        a = count(words[s:s + len(wanted)])
        best = max(best, ((a & b).total() / max(1, (a | b).total()), -s))
    return (best[0], -best[1]) if best[0] >= 0.75 else None


def _compare_windows(spark, docs: dict[int, str], items: dict[int, str]) -> dict:
    frame = spark.createDataFrame([(d, t) for d, t in docs.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(i, t) for i, t in items.items()], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["first_word"]) for r in decontamination.contaminated(frame, bench).collect()}
    want = {(d, i): b for d, t in docs.items() for i, x in items.items() if (b := _best_windows(t, x))}
    return {"missed": want.keys() - got.keys(), "more": got.keys() - want.keys(), "other": [k for k in want.keys() & got.keys() if got[k][1] != want[k][1] or abs(got[k][0] - want[k][0]) > 1e-9], "want": want}


def test_decontamination_of_passages_that_the_text_cuts(spark):
    items = {i: " ".join(f"w{i}_{k}" for k in range(n)) for i, n in enumerate((5, 6, 11, 24, 54, 104))}
    docs = {}
    for i, item in items.items():
        words = item.split()
        for j, share in enumerate((0.7, 0.75, 0.8, 0.85, 0.9)):
            part = " ".join(words[: 4 + round(share * (len(words) - 4))])
            docs |= {100 * i + 2 * j: part, 100 * i + 2 * j + 1: "some words come before it here " + part}
    found = _compare_windows(spark, docs, items)
    assert not found["missed"] and not found["more"] and not found["other"]
    assert {(504, 5), (505, 5), (404, 4), (405, 4)} <= set(found["want"])


def test_decontamination_of_windows_that_simhash_puts_far_off(spark):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(3000)]
    items = {i: " ".join(rng.choices(vocabulary, k=n)) for i, n in enumerate([11, 32, 74, 300] * 15)}
    items |= {100: "all " * 40, 101: " ".join(items[2].split()[:40] + items[6].split()[40:74])}
    docs = {}
    for i, item in items.items():
        words = item.split()
        kept = 4 + -(-6 * (len(words) - 4) // 7)
        docs[i] = " ".join(["before", "it", *words[:kept], *rng.choices(vocabulary, k=len(words) - kept), "and", "after"])
    found = _compare_windows(spark, docs, items)
    assert not found["missed"] and not found["more"] and not found["other"] and len(found["want"]) >= len(items)


def test_toxicity_on_held_out_rows(spark):
    found = toxicity.op4_toxicity_scores(spark, "/root/testdata/sf0.1").where("held_out").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").toPandas()
    flagged = found[found.predicted == 1]
    assert (flagged.toxic == 1).mean() > 0.85 and (flagged.toxic == 1).sum() > 0.65 * (found.toxic == 1).sum()


def test_toxicity_of_odd_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        model = toxicity.train_toxicity(toxicity.labelled_documents(odd, known))
        rows = toxicity.score_toxicity(odd.withColumn("Score", F.lit(5)), model).collect()
        assert len(rows) == len(_odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    seen = np.zeros(1 << toxicity.BITS, bool)
    text = " ".join(_texts(3, 30, 90))
    whole = toxicity.grams(text, seen)
    toxicity_piece, toxicity._PIECE = toxicity._PIECE, 500
    try:
        assert np.array_equal(toxicity.grams(text, seen), whole)
    finally:
        toxicity._PIECE = toxicity_piece


def test_page_text_cases():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header>Site</header><nav><ul><li>a<li>b</ul></nav>
      <!-- c --><div class="cookie-notice">Accept</div><article class="post"><header><h1>Head&amp;line</h1></header><p>One <b>two</b>three<br>four<p>Five&nbsp;six &lt;x&gt; &copy &#233; a < b
      <ul><li>li1<li>li2</ul><table><tr><td>c1<td>c2<tr><td>c3</table><aside>side</aside><form><input value=">">go</form><div id="comments"><p>hi</p></div></article><footer>f</footer></body></html>"""
    assert templates.main_text(page, set()) == "Head&line One twothree four Five six <x> © é a < b li1 li2 c1 c2 c3"
    assert templates.main_text(None, set()) == templates.main_text("", set()) == templates.main_text("<script>x", set()) == templates.main_text("<!-- open", set()) == ""
    assert templates.main_text("plain &amp; text <p>cut here <foot", set()) == "plain & text cut here"
    assert templates.main_text("<div>a</div></b></div>z<p class=ad>no</p>", set()) == "a z"


def test_templates_of_a_host_go(spark):
    rows = [(i, f"http://h.example/{i}", f"<html><body><div class=top>Welcome here</div><div><p>Own text {i}</p></div><div class=end><p>Bye</p></div></body></html>") for i in range(12)]
    rows += [(50, "http://other.example/", "<div class=top>Welcome here</div><p>kept</p>"), (51, None, "<p>no url</p>"), (52, "http://h.example/x", None), (3, "http://h.example/3", rows[3][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("Text", F.lit("old")).withColumn("host", F.lit(1))
    out = templates.extract_text(pages)
    got = {r["page_id"]: r["text"] for r in out.collect()}
    assert out.count() == len(rows) and out.columns == ["page_id", "url", "html", "host", "text"]
    assert all(got[i] == f"Own text {i}" for i in range(12)) and got[50] == "Welcome here kept" and got[51] == "no url" and got[52] == ""
    assert templates.extract_text(pages.limit(0)).count() == 0


def test_copies_of_a_page_are_no_template(spark):
    plain = "<html><body><div class=top>Welcome here</div><div><p>{}</p><ul><li>own list</ul></div></body></html>"
    inside = "<html><body><article><p>{0}</p><section><p>Section of {0}</p></section></article><div class=links>More {1}</div></body></html>"
    rows = [(i, f"http://a.example/{i}", plain.format("The one page")) for i in range(5)]
    rows += [(10 + i, f"http://b.example/{i}", inside.format("The article", i)) for i in range(4)]
    rows += [(20, "http://c.example/", plain.format("Row"))] * 4
    rows += [(100 + i, f"http://d.example/{i}", plain.format("Hot page" if i < 12 else f"Page {i}").replace("own list", f"list {max(i, 11)}")) for i in range(40)]
    got = {r["page_id"]: r["text"] for r in templates.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert all(got[i] == "Welcome here The one page own list" for i in range(5))
    assert all(got[10 + i] == f"The article Section of The article More {i}" for i in range(4)) and got[20] == "Welcome here Row own list"
    assert all(got[100 + i] == ("Hot page list 11" if i < 12 else f"Page {i} list {i}") for i in range(40))


def test_text_outside_of_articles_stays(spark):
    page = "<html><body><nav><a>home</a> {0}</nav><article><p>Paragraph {0}</p><ol><li>one<li>two</ol></article><div class=content>Own text {0}</div><p>Terms apply</p><aside>teaser {0}</aside></body></html>"
    bare = "<html><body><div id=menu-{0}>go {0}</div><p>Only paragraphs {0}</p><footer>Bye {0}</footer></body></html>"
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(5)] + [(10 + i, f"http://b.example/{i}", bare.format(i)) for i in range(5)]
    rows += [(20, "http://a.example/once", page.format("x").replace("<p>Terms", "<p>planted outside</p><p>Terms"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("__marks", F.lit(1)).withColumn("__host", F.lit(2))
    out = templates.extract_text(frame)
    got = {r["page_id"]: r["text"] for r in out.collect()}
    assert out.columns == ["page_id", "url", "html", "__marks", "__host", "text"]
    assert all(got[i] == f"Paragraph {i} one two Own text {i}" and got[10 + i] == f"Only paragraphs {i}" for i in range(5))
    assert got[20] == "Paragraph x one two Own text x planted outside"


def _subtrees(html: str) -> tuple[set[str], set[str], str]:
    """Of well-formed pages: the blocks outside of article and main, the roots that hint at chrome, and the page without the latter; by recursion over the text."""
    from html.parser import HTMLParser

    class Tree(HTMLParser):
        def __init__(self):
            super().__init__()
            self.root = self.at = ["", {}, [], None]

        def handle_starttag(self, tag, attrs):
            node = [tag, dict(attrs), [], self.at]
            self.at[2].append(node)
            if tag not in templates.VOID:
                self.at = node

        def handle_endtag(self, tag):
            node = self.at
            while node is not None and node[0] != tag:
                node = node[3]
            if node is not None:
                self.at = node[3]

        def handle_data(self, data):
            self.at[2].append(data)

    tree = Tree()
    tree.feed(re.sub(r"<b>|</b>|<!--.*?-->|<(script|style|head).*?</\1>", "", html, flags=re.S))
    blocks, hints = set(), set()

    def walk(node, inside):
        if isinstance(node, str):
            return node
        tag, attrs, children, _ = node
        inside = inside or tag in ("article", "main")
        text = "".join(walk(c, inside) for c in children)
        shown = f"<{tag} {attrs.get('class', '')}>{text}"
        if tag in ("nav", "footer", "aside") or "ad" in (attrs.get("class") or "").split():
            hints.add(f"{tag} {attrs.get('class', '')}")
            return ""
        if tag in templates.BLOCK and not inside and tag not in ("html", "body"):
            blocks.add(shown)
        return shown
    return blocks, hints, walk(tree.root, False)


def test_page_texts_come_from_the_counts(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    got = {r["page_id"]: r["text"] for r in templates.extract_text(pages).collect()}
    off = {r["page_id"]: r["text"] for r in templates.extract_text(pages, least_share=2.0).collect()}
    rows = pages.collect()
    hosts, texts = {}, {}
    for page_id, url, html in rows:
        host = url.split("://")[1].split("/")[0] if url and "://" in url else ""
        hosts.setdefault(host, {})[page_id] = _subtrees(html or "")
        texts[page_id] = host
    counted = {h for h, held in hosts.items() if h and len({x[2] for x in held.values()}) >= templates.LEAST_PAGES}
    kinds = {h: Counter(k for k, _ in {(k, x[2]) for x in hosts[h].values() for k in x[1]}) for h in counted}
    marks = {r["host"]: set(r["marks"]) for r in templates.host_templates(pages.select(templates.host_and_path(F.col("url"))[0].alias("host"), "html").where("host <> ''")).collect()}
    assert set(marks) == counted and counted
    for h in counted:
        assert sum(n >= templates.LEAST_PAGES for n in kinds[h].values()) <= len(marks[h])
    assert set(got) == set(off) == set(texts)
    without = {p: templates.main_text(html, frozenset(), True) for p, _, html in rows}
    assert all(got[p] != without[p] for p in got if texts[p] in counted)


def test_deep_and_broken_pages_take_linear_time():
    assert templates.main_text("<div>" * 200_000 + "deep") == "deep"
    assert templates.main_text("<b>" * 100_000 + "</i>" * 100_000 + "x") == "x"
    assert templates.main_text("<p>a<li>b" * 50_000).count("a") == 50_000


def test_nearest_vectors(spark):
    rng = np.random.default_rng(5)
    hot = rng.normal(size=9).round(2).tolist()
    rows = [(i, rng.normal(size=9).round(2).tolist()) for i in range(900)] + [(2000 + i, hot) for i in range(450)]
    rows += [(5000, None), (5020, [0.0] * 9), (5040, [1.0, None] + [0.0] * 7), (5060, [float("nan")] * 9), (5080, [1.0]), (None, hot), (20, rows[20][1])]
    vectors = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).dropDuplicates(["vec_id", "vec"])
    assert vectors.count() == 1350
    known = {r["vec_id"]: np.array(r["vec"]) for r in vectors.collect()}
    got = {}
    for r in neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), query_block=20).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    ids, matrix = np.array(list(known)), np.array(list(known.values()))
    recall = []
    for q, found in got.items():
        scores = (matrix * known[q]).sum(axis=1)
        best = [int(ids[k]) for k in np.lexsort((ids, -scores)) if ids[k] != q][:20]
        recall.append(len({v for v, _ in found} & set(best)) / 20)
        assert len(found) == 20 and found == sorted(found, key=lambda f: (-f[1], f[0])) and all(s == (known[v] * known[q]).sum() for v, s in found)
    assert len(got) == sum(i % 20 == 0 for i in known) and np.mean(recall) >= 0.9
    few = vectors.where("vec_id < 7")
    assert neighbours.nearest(few, few.where("vec_id = 0")).count() == 6 and neighbours.nearest(vectors.limit(0), vectors.limit(0)).count() == 0


def test_probe_order_is_the_sorted_order():
    rng = np.random.default_rng(6)
    index = neighbours.MultiIndex(rng.normal(size=(7, 3)), rng.normal(size=(5, 2)), np.ones(35, int), np.zeros(35, int), np.ones(35, int))
    query = rng.normal(size=5)
    sums = ((index.first @ query[:3])[:, None] + (index.second @ query[3:])[None, :]).ravel()
    assert index.probe(query, 35) == np.argsort(-sums, kind="stable").tolist()


def test_pipeline_stages(spark, sf, odd, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = odd.drop("Kept")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        if name != "mixing":
            assert after.exceptAll(docs).count() == 0
        docs = after
    out = corpus_pipeline.run(spark, str(tmp_path))
    rows = out.collect()
    assert rows and {r["shard"] for r in rows} <= set(range(8)) and all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows))) for s in range(8))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.drop("Kept").limit(0), str(tmp_path)).count() == 0


def test_pipeline_drops_what_it_should(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = corpus_pipeline.toxicity(spark, docs, folder)
    assert 0.85 * docs.count() < clean.count() < docs.count()
    single = corpus_pipeline.near_duplicates(spark, docs, folder)
    groups = minhash.near_duplicates(docs)
    assert single.count() == groups.select("component_id").distinct().count()
    found = decontamination.contaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).select("doc_id").distinct().count()
    assert corpus_pipeline.decontamination(spark, docs, folder).count() == docs.count() - found > 0
