import random

import hypothesis.strategies as st
import pytest
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from hybridloom.functions import citations, headings, html, layout, replies, text as tx


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text, expected", [
    ("First one. Second one! Third?", ["First one.", "Second one!", "Third?"]),
    ("", []), ("   ", []), ("No end", ["No end"]),
    ("Dr. Smith met Mr.  Jones. They spoke.", ["Dr. Smith met Mr. Jones.", "They spoke."]),
    ("Pi is 3.14 here. Next.", ["Pi is 3.14 here.", "Next."]),
    ("The U. States won. Yes.", ["The U. States won.", "Yes."]),
    ('He left. "Why?" (Nobody knew.) end. lower', ["He left.", '"Why?" (Nobody knew.) end. lower']),
])
def test_sentences(spark, text, expected):
    assert one(spark, text, tx.sentences) == expected


def test_unicode_blanks(spark):
    assert one(spark, " a b  c\n", tx.words) == ["a", "b", "c"]
    assert one(spark, "  a  ", tx.strip) == "a"


@pytest.mark.parametrize("n, sizes", [(0, []), (1, [1]), (4, [4]), (5, [4, 1]), (9, [4, 4, 1])])
def test_word_windows(spark, n, sizes):
    text = " \n".join(f"w{i}" for i in range(n))
    found = one(spark, text, lambda v: tx.word_windows(v, 4))
    assert [len(w.split(" ")) for w in found] == sizes and " ".join(found).split() == text.split()


@pytest.mark.parametrize("text, looping", [("a\nb\na\nb", True), ("x\na\n\nb\na\nb", True), ("a\nb\nc\nd", False), ("a\na", False), ("", False), ("a\na\na\na", True),
                                           ("\n".join(f"l{i}" for i in range(30)) + "\n" + "\n".join(f"l{i}" for i in range(30)) + "\n\n", True)])
def test_line_loops(spark, text, looping):
    assert one(spark, text, tx.has_line_loop) is looping


def test_query_terms_and_flags(spark):
    assert one(spark, "How do agents use the AGENTS graph-memory?", tx.query_terms) == ["agents", "graph", "memory", "use"]
    assert one(spark, "see [1, 2]", tx.has_citation) and one(spark, "arXiv:2603.07444", tx.has_citation) and not one(spark, "plain", tx.has_citation)
    assert one(spark, "漢字", tx.has_cjk) and not one(spark, "abc", tx.has_cjk)
    assert one(spark, "2603_07444", tx.document_url) == "https://arxiv.org/abs/2603.07444"


CITED = ["Rivers move sand [7, 12]. Lakes do not.", "Bees dance (Olsen et al., 1998; Marek, 2004). Others watch.", "Tab. 6. lists the ships.", "Two tools, e.g. Saws and files. Both cut.", "nothing to mask",
         "Ref. 9. says so, vs. Fig. 8 in No. 5. Done.", "[2-4, 9] with (McKay & Ode, 1987)"]


def test_mask_restores_every_text(spark):
    rows = spark.createDataFrame([(t,) for t in CITED], "v string").select("v", citations.mask(F.col("v")).alias("m"))
    for r in rows.select("v", "m", citations.restore(F.col("m.masked"), F.col("m.spans")).alias("back")).collect():
        assert r["back"] == r["v"]
        assert all(f"__CITE_{i}__" in r["m"]["masked"] for i in range(len(r["m"]["spans"])))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB .[]()1,2-&;'etalFig\n", max_size=60), min_size=5, max_size=20))
def test_mask_is_invertible(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "v string").select("v", citations.mask(F.col("v")).alias("m"))
    assert all(r["v"] == r["b"] for r in rows.select("v", citations.restore(F.col("m.masked"), F.col("m.spans")).alias("b")).collect())


def test_citations_do_not_end_sentences(spark):
    assert one(spark, "As in Fig. 1. The curve (Smith et al., 2023) rises. It falls.", citations.sentences) == [
        "As in Fig. 1. The curve (Smith et al., 2023) rises.", "It falls."]
    assert one(spark, "word " * 120_000 + "[1] y", lambda v: citations.mask(v)["spans"]) == ["[1]"]


def titles(found):
    return [(s["title"], s["heading_level"]) for s in found]


def test_html_sections(spark):
    page = "<h1>Chapter 1</h1><p>" + "a" * 30 + "</p><h2><span>Section</span> 1.1</h2><p>" + "b &amp; c " * 5 + "</p><h3> </h3><p>" + "lost " * 9 + "</p><h2>Short</h2>x"
    found = one(spark, page, html.sections)
    assert titles(found) == [("Chapter 1", 1), ("Section 1.1", 2)] and "b & c" in found[1]["content"]
    assert titles(one(spark, "<p>no heading, some text</p>", html.sections)) == [("(no title)", 0)]
    assert one(spark, "<script>x</script>", html.sections) == []
    assert one(spark, "a &lt;b&gt; c", html.clean) == "a c"
    assert [tuple(h) for h in one(spark, "<H1>A</h1><h2></h2><h3 class='x'>C</h3><h4>D</h4>", html.headings)] == [(1, "A"), (3, "C")]


def test_tables(spark):
    markup = "<table><tr><th>Method</th><th>Score</th></tr><tr><td> A <b>b</b></td><td>&lt;1</td></tr><tr></tr></table>"
    assert one(spark, [markup, None, " "], html.tables_to_tsv, "array<string>") == ["Method\tScore\nAb\t<1", "", ""]


PAPER = "Tidal mills\nAbstract\nmills turn\nIntroduction\nold mills\n4. Experiments\nwe turned one\nDiscussion\n\nConclusion\nit turned\nReferences\n[1] a mill"
MARKDOWN = "gone\n# Harvest\nwheat\n## Storage\nbarns\n### Losses\nmice\n## Nothing\n\n## 7. References\nr\n# B. Appendix\nz"


def test_paper_and_markdown_sections(spark):
    found = one(spark, PAPER, headings.paper_sections)
    assert [s["title"] for s in found] == ["Abstract", "Introduction", "4. Experiments", "Conclusion"]
    assert [s["section_index"] for s in found] == [0, 1, 2, 3]
    assert titles(one(spark, MARKDOWN, headings.markdown_sections)) == [("Harvest", 1), ("Storage", 2), ("Losses", 3)]
    for split in (headings.paper_sections, headings.markdown_sections):
        assert titles(one(spark, "just text", split))[0][0] == "Full Text"
    assert titles(one(spark, "# References\na\n# Bibliography\nb", headings.markdown_sections)) == [("Full Text", 1)]
    assert one(spark, MARKDOWN, headings.heading_census).asDict() == {"h1": 2, "h2": 3, "h3": 1}


@pytest.mark.parametrize("title, level, excluded", [("References", 3, True), ("5. References", 2, True), ("BIBLIOGRAPHY", 1, True), ("Appendix", 1, True),
                                                    ("Appendix", 3, False), ("Appendix A", 1, False), ("Appendices", 2, True), ("Method", 1, False)])
def test_layout_exclusion(spark, title, level, excluded):
    assert one(spark, title, lambda v: headings.excluded_layout(v, F.lit(level))) is excluded


def test_layout_sections(spark):
    import json
    span = lambda *t: [{"type": "text", "content": x} for x in t]
    pages = [[{"type": "paragraph", "content": {"paragraph_content": span("before")}}, {"type": "page_footnote", "content": {}}, "junk", {"no": "type"},
              {"type": "title", "content": {"title_content": span("Intro", "duction"), "level": True}},
              {"type": "paragraph", "content": {"paragraph_content": span("a", "b ", "c") + [{"type": "equation_inline", "content": "x=1"}, {"type": "odd", "content": "z"}]}},
              {"type": "paragraph", "content": {"paragraph_content": "not a list"}},
              {"type": "list", "content": {"list_items": [{"item_content": span("one")}, {"item_content": []}, 5]}}],
             "no page",
             [{"type": "table", "content": {"table_caption": span("Tab"), "html": "<tr><td>1</td><td>2</td></tr>"}},
              {"type": "title", "content": {"title_content": [], "level": 2}}, {"type": "code", "content": {"code_content": span("print")}},
              {"type": "title", "content": {"title_content": span("References"), "level": 2}}, {"type": "algorithm", "content": {"algorithm_content": span("x")}},
              {"type": "title", "content": {"title_content": span("Empty"), "level": 2}}]]
    found = one(spark, json.dumps(pages), layout.sections)
    assert [(s["section_index"], s["title"], s["heading_level"], s["content"]) for s in found] == [
        (0, "Preamble", 1, "before"), (1, "Intro duction", 1, "a b c x=1\n\none\n\nTab\n1\t2"), (2, "Untitled-2", 2, "print")]
    assert one(spark, "no json", lambda v: F.coalesce(layout.sections(v), F.array())) == []


@pytest.mark.parametrize("raw, ok, error", [
    ('```json\n{"chunks": [{"id": "a", "relevance": 3}, {"id": "b", "relevance": 99}, {"id": "a", "relevance": 1}], "reply": "r", "satisfaction": 7}\n```', True, None),
    ('<think>hm</think>{"chunks": [{"id": "a", "relevance": 3}], "reply": "r", "satisfaction": 7}', False, "chunks array length mismatch"),
    ('{"chunks": [{"id": "a", "relevance": 3}, {"id": "z", "relevance": 3}], "reply": "r", "satisfaction": 7}', False, "unknown id"),
    ('{"chunks": [{"id": "a", "relevance": "3"}, {"id": "b", "relevance": 3}], "reply": "r", "satisfaction": 7}', False, "relevance not int"),
    ('{"chunks": [{"id": "a", "relevance": 3}, {"id": "b", "relevance": 3}], "reply": "two\nlines", "satisfaction": 11}', False, "satisfaction not int 1..10"),
    ("no json", False, "missing chunks"),
])
def test_judgements(spark, raw, ok, error):
    got = one(spark, raw, lambda v: replies.parse_judgement(v, F.array(F.lit("a"), F.lit("b"))))
    assert (got["parse_ok"], got["error"]) == (ok, error)
    if ok:
        assert [(c["id"], c["relevance"]) for c in got["parsed"]["chunks"]] == [("a", 3), ("b", 99)]


def test_small_replies(spark):
    assert one(spark, '```\n{"winner": "B"}\n```', replies.winner) == "B" and one(spark, "junk", replies.winner) == "tie"
    assert one(spark, '{"score": 3}', lambda v: replies.score_or(v, 1, 3, 2)) == 3 and one(spark, '{"score": 7}', lambda v: replies.score_or(v, 1, 3, 2)) == 2
    assert one(spark, " 0.25 ", replies.unit_score) == 0.25 and one(spark, "I think 0.7!", replies.unit_score) == 0.7 and one(spark, "9", replies.unit_score) is None
    assert one(spark, '{"results": [{"markdown": "# x"}]}', replies.markdown_of) == "# x"


def test_restore_is_one_pass(spark):
    rows = spark.createDataFrame([("a __CITE_0__ b __CITE_1__ __CITE_99999999999__", ["__CITE_1__", "x"])], "v string, spans array<string>")
    assert rows.select(citations.restore(F.col("v"), F.col("spans"))).first()[0] == "a __CITE_1__ b x __CITE_99999999999__"


def test_plain_tables_need_no_parser(monkeypatch):
    import random
    rng = random.Random(4)
    bits = ["<tr>", "</tr>", "<td>", "</td>", "<TH>", "</th>", "<b>", "</b>", "<table>", "</table>", " a ", "b&amp;c", "&lt", "&#x41;", "&", "&amp", " ", "é\n"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(3000)]

    def parsed(markup):
        parser = html._Table()
        parser.feed(markup)
        parser.close()
        return "\n".join("\t".join(cells) for cells in parser.rows if cells)

    expected = [parsed(m) if m.strip() else "" for m in made]
    attributed = "<table><tr><td class='x<y'>1</td><td><!-- <td>no</td> -->2</td></tr></table>"
    assert html.table_to_tsv(attributed) == parsed(attributed) == "1\t2"
    monkeypatch.setattr(html, "_Table", None)
    assert [html.table_to_tsv(m) for m in made] == expected


def test_quick_patterns_find_what_the_plain_ones_do(spark):
    """Sentence and citation patterns look at two letters first, and trimming needs no pattern; results are those of the plain forms."""
    parts = ["et al.", "I.E.", "i.e.", "e.g.", "E.G.", "cf.", "Figs.", "Fi\u0261.", "fig. 3.", "Eqs.", "Tab.", "Table. 4.", "\u017fec.", "Sec. 1.", "Ref.", "Vol.", "No.", "v\u017f.", "vs.", "F\u0130g.", "f\u0131g.", "F\u0131gs.",
             "Dr. A", "mr.  B", "M\u017f. C", "\u017ft. D", "Prof.\u00a0E", "Lt. 'x", "maj.\u3000(y", "x", "\u00e9", " ", "\u2003", "\x85", "\n", "\x1c", "\x0b", "[1]", "U. S.", "!", "? ", "Q", "_", "9", "\U0001d400", "."]
    picked = random.Random(3)
    texts = ["", " ", "\u2003 \n"] + ["".join(picked.choice(parts) for _ in range(picked.randint(1, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    abbreviations = r"(?iU)(?<!\w)(?:" + "|".join(a.replace(".", r"\.") for a in sorted(citations.ABBREVIATIONS, key=len, reverse=True)) + ")"
    numbered = r"(?i)(?:Fig(?:s)?|Eq(?:s)?|Tab(?:le)?|Sec|Ref)\.\s*\d+\."
    trimmed = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    glued = F.regexp_replace("t", rf"(?U)(?<![^\s])((?i:{tx.TITLE_ABBREVIATIONS})\.)\s+{tx.SENTENCE_OPENER}", "$1\u0001")
    plain = F.filter(F.transform(F.split(glued, rf"(?U)(?<=[.!?])(?<!\b\w\.)\s+{tx.SENTENCE_OPENER}"), lambda s: F.regexp_replace(trimmed(s), "\u0001", " ")), lambda s: s != "")
    found = lambda p: F.regexp_extract_all("t", F.lit(p), F.lit(0))
    same = df.select((found(citations.PATTERNS[3]) == found(abbreviations)).alias("a"), (found(citations.NUMBERED) == found(numbered)).alias("n"),
                     (tx.strip(F.col("t")) == trimmed(F.col("t"))).alias("s"), (tx.sentences(F.col("t")) == plain).alias("p"))
    assert [r for r in same.collect() if not all(r)] == [] and df.select(F.sum(F.size(found(abbreviations)))).first()[0] > 1000
    for quick in (citations.PATTERNS[3], citations.NUMBERED, tx.strip(F.col("t"))._jc.toString()):
        assert "(?=" in quick or "regexp" not in quick and "trim" in quick


def test_mask_goes_once_through_a_text(spark):
    """Texts that hold the mark itself get the same placeholders and spans as others."""
    texts = ["", "[1]", "[1][2]", "see [1], cf. Fig. 2. and et al.", "cf. x [3]", None]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, i int").select("i", "t", F.concat("t", F.lit(citations.MARK)).alias("u"))
    rows = df.select("t", "u", citations.mask(F.col("t")).alias("m"), citations.mask(F.col("u")).alias("n")).orderBy("i").collect()
    assert [r["m"]["spans"] for r in rows][:5] == [[], ["[1]"], ["[1]", "[2]"], ["[1]", "Fig. 2.", "cf.", "et al."], ["[3]", "cf."]]
    assert rows[3]["m"]["masked"] == "see __CITE_0__, __CITE_2__ __CITE_1__ and __CITE_3__"
    assert all(r["n"]["spans"] == r["m"]["spans"] and r["n"]["masked"] == (r["m"]["masked"] + citations.MARK if r["t"] is not None else None) for r in rows)
    assert "regexp_replace" in citations.mask(F.col("t"))._jc.toString()


def test_terms_are_hashed_in_one_go(monkeypatch):
    import pyarrow as pa
    from hybridloom.functions import encoders
    words = ["a", "\u00e9t\u00e9", "x1", "\u4e00", "", *(f"w{i}" for i in range(500))]
    single = [encoders.term_slot(w, 50) for w in words]
    slots, signs = encoders.term_slots(pa.array(words), 50)
    assert list(zip(slots.tolist(), signs.tolist())) == single

    def one_by_one(*_):
        raise AssertionError("a term at a time")

    monkeypatch.setattr(encoders, "term_slot", one_by_one)
    dense = encoders.hash_terms(pa.array([["a", "a", "x1"], [], None, words]), 50)
    assert dense[0][single[0][0]] in (2 * single[0][1], 2 * single[0][1] + single[2][1]) and not dense[1:3].any()
    assert dense[3].sum() == sum(sign for _, sign in single)
