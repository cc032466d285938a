"""Text, HTML, Markdown, paper and layout functions over whole documents and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridloom.functions import citations, headings, html, layout, replies, text as tx
from hybridloom.session import spread
from hybridloom.workload import tables as tb
from hybridloom.workload.registry import query


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return spread(tb.table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars"))


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(tb.table(spark, sf, "pages"))


# White-space trimming of both engines: ASCII and Unicode blanks.
_TRIM = r"regexp_replace({}, '^[\s\x{{0b}}\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]+|[\s\x{{0b}}\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]+$', '', 'g')"


def _trim(value: str) -> str:
    return _TRIM.format(value)


@query("token_count", "SELECT doc_id, length(text) // 4 AS tokens FROM documents")
def token_count(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", tx.token_estimate(F.col("text")).cast("long").alias("tokens"))


@query("token_totals", """SELECT source, sum(length(text) // 4)::BIGINT AS tokens, round(avg(length(text) // 4), 6) AS mean_tokens,
 count(*) FILTER (length(text) // 4 < 50) AS small FROM documents GROUP BY 1""")
def token_totals(spark: SparkSession, sf: str) -> DataFrame:
    counted = docs(spark, sf).select("source", tx.token_estimate(F.col("text")).cast("long").alias("t"))
    return counted.groupBy("source").agg(F.sum("t").alias("tokens"), F.round(F.avg("t"), 6).alias("mean_tokens"),
                                         F.count_if(F.col("t") < 50).alias("small"))


@query("paragraph_split", rf"""WITH t AS (SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS text FROM documents),
 p AS (SELECT doc_id, unnest(string_split_regex(text, '\n\s*\n')) AS para FROM t), s AS (SELECT doc_id, {_trim('para')} AS para FROM p)
SELECT doc_id, count(*) AS paragraphs, sum(length(para))::BIGINT AS chars, max(length(para) // 4) AS longest_tokens FROM s WHERE para <> '' GROUP BY 1""")
def paragraph_split(spark: SparkSession, sf: str) -> DataFrame:
    """Every line break counts as a blank line here, so that each line is a paragraph."""
    split = docs(spark, sf).select("doc_id", F.explode(tx.paragraphs(F.replace("text", F.lit("\n"), F.lit("\n\n")))).alias("p"))
    return split.groupBy("doc_id").agg(F.count("*").alias("paragraphs"), F.sum(F.length("p")).cast("long").alias("chars"),
                                       F.max(tx.token_estimate(F.col("p"))).cast("long").alias("longest_tokens"))


@query("word_windows_512", r"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS ws FROM documents)
SELECT doc_id, s AS window_no, md5(array_to_string(ws[s * 512 + 1 : s * 512 + 512], ' ')) AS text_md5
FROM (SELECT doc_id, ws, unnest(range(0, (len(ws) + 511) // 512)) AS s FROM w)""")
def word_windows(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", F.posexplode(tx.word_windows(F.col("text"), 512)).alias("w", "text")).select(
        "doc_id", F.col("w").cast("long").alias("window_no"), F.md5("text").alias("text_md5"))


def _sql_cut(value: str, word: str = r"[\p{L}\p{N}_]", other: str = r"[^\p{L}\p{N}_]") -> str:
    """chr(1) at sentence ends, chr(2) after single letters with a dot, chr(3) after title abbreviations."""
    titles = rf"'(^|\s)((?i:{tx.TITLE_ABBREVIATIONS})\.)\s+([A-Z\"''(])', '\1\2' || chr(3) || '\3', 'g'"
    glued = f"regexp_replace(regexp_replace({value}, {titles}), {titles})"
    letters = f"regexp_replace({glued}, '(^|{other})({word}\\.)', '\\1\\2' || chr(2), 'g')"
    return rf"regexp_replace({letters}, '([.!?])\s+([A-Z\"''(])', '\1' || chr(1) || '\2', 'g')"


SENTENCES_SQL = rf"""s0 AS (SELECT doc_id, string_split({_sql_cut('text')}, chr(1)) AS l FROM documents),
 s1 AS (SELECT doc_id, replace(replace(unnest(l), chr(2), ''), chr(3), ' ') AS t, generate_subscripts(l, 1) - 1 AS pos FROM s0),
 sentences AS (SELECT doc_id, pos, {_trim('t')} AS sentence FROM s1 WHERE {_trim('t')} <> '')"""


@query("sentence_split", f"WITH {SENTENCES_SQL} SELECT doc_id, pos, md5(sentence) AS sentence_md5 FROM sentences")
def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("pos", "s")).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), F.md5("s").alias("sentence_md5"))


_REMARK = ". See Fig. 1. and (Smith et al., 2023; Jones, 2022) or [1, 2-4], i.e. "
_CITED = f"replace(replace(text, ', ', ', cf. '), '. ', '{_REMARK}')"


def _cited() -> Column:
    return F.replace(F.replace(F.col("text"), F.lit(", "), F.lit(", cf. ")), F.lit(". "), F.lit(_REMARK))


_MASKED = (r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(c, '\[(\d+(\s*[-–]\s*\d+)?(\s*,\s*\d+(\s*[-–]\s*\d+)?)*)\]', '@#', 'g'), """
           r"""'\(([A-Z][A-Za-z''\-]+(\s+(et\s+al\.|&\s*[A-Z][A-Za-z''\-]+))?,?\s*\d{4}(\s*;\s*[A-Z][A-Za-z''\-]+(\s+(et\s+al\.|&\s*[A-Z][A-Za-z''\-]+))?,?\s*\d{4})*)\)', '@#', 'g'), """
           r"""'(Figs?|Eqs?|Tab(le)?|Sec|Ref)\.\s*\d+\.', '@#', 'gi'), """
           r"""'(^|[^\p{L}\p{N}_])(et al\.|Figs\.|i\.e\.|e\.g\.|Fig\.|Eqs\.|Tab\.|Sec\.|Ref\.|Vol\.|cf\.|Eq\.|No\.|vs\.)', '\1@#', 'gi')""")


@query("citation_mask", rf"""WITH t AS (SELECT doc_id, {_CITED} AS c FROM documents), m AS (SELECT doc_id, c, {_MASKED} AS m FROM t)
SELECT doc_id, md5(m) AS masked_md5, (length(m) - length(replace(m, '@#', ''))) // 2 AS spans, true AS restored FROM m""")
def citation_mask(spark: SparkSession, sf: str) -> DataFrame:
    """Mask, and put everything back. The texts get citations inserted after full stops and commas."""
    cited = docs(spark, sf).select("doc_id", _cited().alias("c"))
    masked = cited.select("doc_id", "c", citations.mask(F.col("c")).alias("m"))
    plain = F.regexp_replace("m.masked", r"__CITE_\d+__", "@#")
    return masked.select("doc_id", F.md5(plain).alias("masked_md5"), F.size("m.spans").cast("long").alias("spans"),
                         (citations.restore(F.col("m.masked"), F.col("m.spans")) == F.col("c")).alias("restored"))


@query("citation_aware_sentences", f"""WITH t AS (SELECT doc_id, {_CITED} AS c FROM documents), m AS (SELECT doc_id, {_MASKED} AS m FROM t),
 s AS (SELECT doc_id, string_split({_sql_cut('m', other=r"[^\p{L}\p{N}_#]")}, chr(1)) AS l FROM m)
SELECT doc_id, len(list_filter(l, lambda x: trim(x) <> '')) AS sentences FROM s""")
def citation_aware_sentences(spark: SparkSession, sf: str) -> DataFrame:
    cited = docs(spark, sf).select("doc_id", citations.mask(_cited()).alias("m"))
    return cited.select("doc_id", F.size(citations.sentences_of(F.col("m"))).cast("long").alias("sentences"))


@query("citation_flags", rf"""WITH t AS (SELECT doc_id, CASE WHEN lang = 'en' THEN replace(text, '. ', ' [' || doc_id || ']. ') WHEN lang = 'fr' THEN text || ' (Smith, 2024)'
   WHEN lang = 'es' THEN text || ' et al., 2021' ELSE text END AS c FROM documents)
SELECT doc_id, regexp_matches(c, '\[\d[\d, ]*\]') OR regexp_matches(c, '\([A-Z][a-z]+(, [A-Z][a-z]+)*, \d{{4}}\)')
 OR regexp_matches(c, '(et al\.|et al)\s*,\s*\d{{4}}') OR regexp_matches(c, 'arXiv[:\s]*\d+\.\d{{4,}}') AS cited FROM t""")
def citation_flags(spark: SparkSession, sf: str) -> DataFrame:
    text, lang = F.col("text"), F.col("lang")
    marked = (F.when(lang == "en", F.replace(text, F.lit(". "), F.concat(F.lit(" ["), F.col("doc_id").cast("string"), F.lit("]. "))))
              .when(lang == "fr", F.concat(text, F.lit(" (Smith, 2024)")))
              .when(lang == "es", F.concat(text, F.lit(" et al., 2021"))).otherwise(text))
    return docs(spark, sf).select("doc_id", tx.has_citation(marked).alias("cited"))


_STOPS = "[" + ", ".join(f"'{w}'" for w in tx.STOP_WORDS) + "]"


@query("query_terms", f"""SELECT item_id AS query_id, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(lower(text), '[A-Za-z]+')),
 lambda w: length(w) >= 3 AND NOT list_contains({_STOPS}, w))), ' ') AS terms FROM benchmark""")
def query_terms(spark: SparkSession, sf: str) -> DataFrame:
    return tb.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.array_join(tx.query_terms(F.col("text")), " ").alias("terms"))


@query("fingerprints", f"SELECT doc_id, md5(lower({_trim('text')})) AS fingerprint FROM documents")
def fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", tx.fingerprint(F.col("text")).alias("fingerprint"))


@query("metadata_prefix", """SELECT doc_id, trim('category:' || lang || CASE WHEN n_chars > 2000 THEN ' subcategory:' || source ELSE '' END || ' section:' || source) AS prefix FROM documents""")
def metadata_prefix(spark: SparkSession, sf: str) -> DataFrame:
    sub = F.when(F.col("n_chars") > 2000, F.col("source")).otherwise("")
    return docs(spark, sf).select("doc_id", tx.metadata_prefix(F.col("lang"), sub, F.lit(None).cast("string"), F.col("source")).alias("prefix"))


@query("collection_names", r"""SELECT page_id, substr(regexp_replace(lower(trim(url)), '[^\p{L}\p{N}\-_.]', '', 'g'), 1, 63) AS name FROM pages""")
def collection_names(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).select("page_id", tx.collection_name(F.col("url")).alias("name"))


@query("cjk_exclusion", r"SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{f900}-\x{faff}]')")
def cjk_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).filter(~tx.has_cjk(F.col("text"))).select("doc_id")


@query("line_loops", r"""WITH l AS (SELECT doc_id, list_filter(string_split_regex(text, '\r\n|\r|\n'), lambda s: regexp_replace(s, '[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+', '', 'g') <> '') AS l FROM documents)
SELECT doc_id, len(list_filter(range(2, len(l) // 2 + 1), lambda k: l[len(l) - k + 1:len(l)] = l[len(l) - 2 * k + 1:len(l) - k])) > 0 AS looping FROM l""")
def line_loops(spark: SparkSession, sf: str) -> DataFrame:
    """Texts whose last block of lines repeats the block before it."""
    return docs(spark, sf).select("doc_id", tx.has_line_loop(F.col("text")).alias("looping"))


@query("document_urls", "SELECT DISTINCT source AS document_id, 'https://arxiv.org/abs/' || replace(source || '_' || lang, '_', '.') AS url FROM documents")
def document_urls(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select(F.col("source").alias("document_id"), tx.document_url(F.concat_ws("_", "source", "lang")).alias("url")).distinct()


# Entities that occur in the pages, decoded in the order of one pass.
_DECODE = "regexp_replace(replace(replace(replace({}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;?', '&', 'g')"


def _clean(value: str) -> str:
    bare = rf"regexp_replace(regexp_replace({value}, '<script[^>]*>.*?</script>', '', 'gs'), '<style[^>]*>.*?</style>', '', 'gs')"
    flat = rf"regexp_replace({_DECODE.format(bare)}, '<[^>]+>', '', 'g')"
    return _trim(rf"regexp_replace(regexp_replace({flat}, '\n+', chr(10), 'g'), ' {{2,}}', ' ', 'g')")


@query("html_clean_text", f"SELECT page_id, md5({_clean('html')}) AS text_md5, length({_clean('html')}) AS chars FROM pages")
def html_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = pages(spark, sf).select("page_id", html.clean(F.col("html")).alias("t"))
    return cleaned.select("page_id", F.md5("t").alias("text_md5"), F.length("t").cast("long").alias("chars"))


# Pages have one heading each; bold lead-ins become second-level headings for these two queries.
_HEADED = r"""regexp_replace(html, '<b>(.*?)<br>', '<h2 class="x">\1</h2>', 'gs')"""


def _headed() -> Column:
    return F.regexp_replace("html", r"(?s)<b>(.*?)<br>", '<h2 class="x">$1</h2>')


@query("html_headings", rf"""WITH t AS (SELECT page_id, regexp_extract_all({_HEADED}, '<h[1-3][^>]*>.*?</h[1-3]>', 0, 's') AS hs FROM pages),
 u AS (SELECT page_id, unnest(hs) AS h, generate_subscripts(hs, 1) AS i FROM t)
SELECT page_id, i - 1 AS pos, substr(h, 3, 1)::BIGINT AS level, {_trim("regexp_replace(h, '<[^>]+>', '', 'g')")} AS title FROM u""")
def html_headings(spark: SparkSession, sf: str) -> DataFrame:
    found = pages(spark, sf).select("page_id", F.posexplode(html.headings(_headed())).alias("pos", "h"))
    return found.select("page_id", F.col("pos").cast("long").alias("pos"), F.col("h.level").cast("long").alias("level"), F.col("h.title").alias("title"))


_SECTION_COLUMNS = "page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS section_index, title, level AS heading_level, md5(content) AS content_md5"


@query("html_sections", rf"""WITH t AS (SELECT page_id, {_HEADED} AS html FROM pages),
 m AS (SELECT page_id, regexp_extract_all(html, '<h[1-3][^>]*>.*?</h[1-3]>', 0, 's') AS hs,
   string_split_regex(regexp_replace(html, '<h[1-3][^>]*>.*?</h[1-3]>', chr(1), 'gs'), chr(1)) AS ps FROM t),
 u AS (SELECT page_id, unnest(hs) AS h, unnest(ps[2:]) AS raw, generate_subscripts(hs, 1) AS i FROM m),
 s AS (SELECT page_id, i, substr(h, 3, 1)::BIGINT AS level, {_trim("regexp_replace(h, '<[^>]+>', '', 'g')")} AS title, {_clean('raw')} AS content FROM u),
 kept AS (SELECT * FROM s WHERE title <> '' AND length(content) > 20),
 whole AS (SELECT page_id, 1 AS i, 0 AS level, '(no title)' AS title, {_clean('html')} AS content FROM t ANTI JOIN kept USING (page_id))
SELECT {_SECTION_COLUMNS} FROM (SELECT page_id, i, level, title, content FROM kept UNION ALL SELECT page_id, i, level, title, content FROM whole WHERE content <> '')""")
def html_sections(spark: SparkSession, sf: str) -> DataFrame:
    found = pages(spark, sf).select("page_id", F.inline(html.sections(_headed())))
    return found.select("page_id", F.col("section_index").cast("long").alias("section_index"), "title",
                        F.col("heading_level").cast("long").alias("heading_level"), F.md5("content").alias("content_md5"))


# Lines of a document get a heading every third line, so that both splitters find structure.
_MD_HEADS = ["# Introduction", "## Data Collection", "### 5. References", "## A. Appendix", "# Results"]
_PAPER_HEADS = ["Abstract", "1. Introduction", "Methods", "7. References", "Conclusion"]


def _structured(heads: list[str]) -> Column:
    lines = F.split("text", "\n")
    names = F.array(*[F.lit(h) for h in heads])
    return F.array_join(F.transform(lines, lambda line, i: F.when(
        F.pmod(i, F.lit(3)) == 1, F.concat(F.get(names, F.pmod(F.floor(i / 3), F.lit(len(heads))).cast("int")), F.lit("\n"), line)
    ).otherwise(line)), "\n")


def _sql_structured(heads: list[str]) -> str:
    names = "[" + ", ".join(f"'{h}'" for h in heads) + "]"
    return f"""array_to_string(list_transform(string_split(text, chr(10)), lambda line, i: CASE WHEN (i - 1) % 3 = 1
      THEN {names}[((i - 1) // 3) % {len(heads)} + 1] || chr(10) || line ELSE line END), chr(10))"""


def _sql_split(text: str, pattern: str, options: str, excluded: str, level: str) -> str:
    mark = f"regexp_replace({text}, '{pattern}', chr(1) || '\\0' || chr(2), '{options}')"
    return rf"""WITH t AS (SELECT doc_id, {text} AS text FROM documents),
 m AS (SELECT doc_id, text, string_split({mark.replace(text, 'text')}, chr(1)) AS ps FROM t),
 u AS (SELECT doc_id, unnest(ps[2:]) AS p, generate_subscripts(ps[2:], 1) AS i, len(ps) - 1 AS n FROM m),
 s AS (SELECT doc_id, i, n, split_part(p, chr(2), 1) AS head, {_trim("substr(p, strpos(p, chr(2)) + 1)")} AS content FROM u),
 h AS (SELECT *, {_trim("regexp_replace(head, '^#+', '')")} AS title, {level} AS level FROM s),
 kept AS (SELECT * FROM h WHERE n >= 2 AND content <> '' AND NOT ({excluded})),
 whole AS (SELECT doc_id, 1 AS i, 'Full Text' AS title, 1 AS level, {_trim('text')} AS content FROM t ANTI JOIN kept USING (doc_id))
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS section_index, title, level::BIGINT AS heading_level, md5(content) AS content_md5
FROM (SELECT doc_id, i, title, level, content FROM kept UNION ALL SELECT doc_id, i, title, level, content FROM whole)"""


_BACK = "('references', 'bibliography', 'appendix')"


def _shown_sections(df: DataFrame, found: Column) -> DataFrame:
    return df.select("doc_id", F.inline(found)).select(
        "doc_id", F.col("section_index").cast("long").alias("section_index"), "title",
        F.col("heading_level").cast("long").alias("heading_level"), F.md5("content").alias("content_md5"))


@query("markdown_sections", _sql_split(_sql_structured(_MD_HEADS), r"(?m)^#{1,3}\s+.+", "g",
       rf"lower(trim(regexp_replace(title, '^[A-Za-z0-9]+\.?\s*', ''))) IN {_BACK} OR lower(trim(title)) IN {_BACK}",
       "length(regexp_extract(head, '^#+'))"))
def markdown_sections(spark: SparkSession, sf: str) -> DataFrame:
    return _shown_sections(docs(spark, sf), headings.markdown_sections(_structured(_MD_HEADS)))


@query("paper_sections", _sql_split(_sql_structured(_PAPER_HEADS),
       r"(?mi)^((Abstract|Introduction|Related\s+Work|Background|Methodology|Methods?|Approach|Experiments?|Results?|Evaluation|Discussion|Analysis|"
       r"Conclusion|Summary|Future\s+Work|References|Bibliography|Appendix)|(\d+\.?\s+[\p{L}\p{N}_].{2,60}))$", "g",
       rf"lower(trim(regexp_replace(title, '^\d+\.?\s*', ''))) IN {_BACK}", "NULL::BIGINT").replace("1 AS level", "1::BIGINT AS level"))
def paper_sections(spark: SparkSession, sf: str) -> DataFrame:
    return _shown_sections(docs(spark, sf), headings.paper_sections(_structured(_PAPER_HEADS)))


@query("heading_census", rf"""WITH t AS (SELECT doc_id, {_sql_structured(_MD_HEADS)} AS text FROM documents)
SELECT doc_id, len(regexp_extract_all(text, '(?m)^#\s')) AS h1, len(regexp_extract_all(text, '(?m)^##\s')) AS h2,
 len(regexp_extract_all(text, '(?m)^###\s')) AS h3 FROM t""")
def heading_census(spark: SparkSession, sf: str) -> DataFrame:
    counted = docs(spark, sf).select("doc_id", headings.heading_census(_structured(_MD_HEADS)).alias("c"))
    return counted.select("doc_id", *[F.col(f"c.{h}").cast("long").alias(h) for h in ("h1", "h2", "h3")])


def _layout_json() -> Column:
    """A layout document per text: one page, a title every fourth line, paragraphs, a list and a table."""
    span = lambda v: F.array(F.struct(F.lit("text").alias("type"), v.alias("content")))
    lines = F.split("text", "\n")
    none = F.lit(None)

    def block(line: Column, i: Column) -> Column:
        kind = F.element_at(F.array(*[F.lit(k) for k in ("title", "paragraph", "list", "page_footer")]), F.pmod(i, F.lit(4)).cast("int") + 1)
        name = F.when(F.pmod(i, F.lit(12)) == 8, F.lit("9. References")).otherwise(F.concat(F.lit("Part "), i.cast("string")))
        return F.struct(kind.alias("type"), F.struct(
            F.when(kind == "title", span(name)).alias("title_content"),
            F.when(kind == "title", (F.pmod(i, F.lit(3)) + 1).cast("int")).alias("level"),
            F.when(kind == "paragraph", span(line)).alias("paragraph_content"),
            F.when(kind == "list", F.array(F.struct(span(line).alias("item_content")), F.struct(span(F.lit("last item")).alias("item_content")))).alias("list_items"),
            F.when(kind == "page_footer", F.lit("skip")).alias("footer")).alias("content"))

    return F.to_json(F.array(F.transform(lines, block)))


_LAYOUT_SQL = f"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
 u AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i FROM l),
 b AS (SELECT doc_id, i // 4 AS part, i, CASE i % 4 WHEN 1 THEN {_trim('line')} WHEN 2 THEN CASE WHEN {_trim('line')} = '' THEN 'last item' ELSE {_trim('line')} || chr(10) || 'last item' END END AS t FROM u WHERE i % 4 IN (1, 2)),
 s AS (SELECT doc_id, part, string_agg(t, chr(10) || chr(10) ORDER BY i) AS content FROM b WHERE t <> '' GROUP BY 1, 2),
 n AS (SELECT doc_id, part, CASE WHEN (part * 4) % 12 = 8 THEN '9. References' ELSE 'Part ' || (part * 4) END AS title, (part * 4) % 3 + 1 AS level, content FROM s)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY part) - 1 AS section_index, title, level AS heading_level, md5(content) AS content_md5
FROM n WHERE title <> '9. References'"""


@query("layout_sections", _LAYOUT_SQL)
def layout_sections(spark: SparkSession, sf: str) -> DataFrame:
    return _shown_sections(docs(spark, sf), layout.sections(_layout_json()))


@query("html_tables", f"""WITH l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: array_to_string(list_filter(string_split_regex({_trim('x')}, '\\s+'), lambda w: true), chr(9))) AS rows FROM documents)
SELECT doc_id, md5(array_to_string(rows, chr(10))) AS tsv_md5 FROM l""")
def html_tables(spark: SparkSession, sf: str) -> DataFrame:
    """A table per text: lines are rows, words are cells; rendered back as tab-separated rows."""
    cell = lambda w: F.concat(F.lit("<td> "), F.replace(F.replace(F.replace(w, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("</td>"))
    row = lambda line: F.concat(F.lit("<tr>"), F.array_join(F.transform(F.split(tx.strip(line), r"(?U)\s+"), cell), ""), F.lit("</tr>"))
    table = F.concat(F.lit("<table>"), F.array_join(F.transform(F.split("text", "\n"), row), "\n"), F.lit("</table>"))
    return docs(spark, sf).select("doc_id", F.md5(html.tables_to_tsv(F.array(table))[0]).alias("tsv_md5"))


@query("reply_parsing", """WITH t AS (SELECT doc_id, quality, toxic FROM labels)
SELECT doc_id, toxic = 0 AS parse_ok, CASE WHEN toxic = 0 THEN 2 + quality * 7 END::BIGINT AS satisfaction,
 CASE WHEN toxic = 0 THEN 10 + quality END::BIGINT AS relevance, CASE WHEN quality = 1 THEN 'A' ELSE 'tie' END AS winner,
 CASE WHEN quality = 1 THEN 3 ELSE 2 END::BIGINT AS score, CASE WHEN quality = 1 THEN 0.75 END::DOUBLE AS verdict FROM t""")
def reply_parsing(spark: SparkSession, sf: str) -> DataFrame:
    """Judge replies written from the labels: fenced, with a think block, a raw line break and a repeated id."""
    rows = spread(tb.table(spark, sf, "labels"))
    quality, toxic = F.col("quality"), F.col("toxic")
    doc = F.concat(F.lit('<think>{"a": 1}</think>\\n```json\\n'.replace("\\n", "\n")),
                   F.lit('{"chunks": [{"id": "c1", "relevance": '), (quality + 10).cast("string"), F.lit(', "reason": "a\nb"}, {"id": "c1", "relevance": 1}'),
                   F.lit('], "reply": "r", "satisfaction": '), F.when(toxic == 0, (quality * 7 + 2).cast("string")).otherwise('"high"'), F.lit("}\n```"))
    judged = rows.select("doc_id", "quality", replies.parse_judgement(doc, F.array(F.lit("c1"))).alias("j"))
    won = F.when(quality == 1, F.lit('```json\n{"winner": "A", "reason": "x"}\n```')).otherwise("no json")
    scored = F.when(quality == 1, F.lit('{"score": 3}')).otherwise('{"score": 9}')
    said = F.when(quality == 1, F.lit("I say .75 here 0.75")).otherwise("none")
    return judged.select(
        "doc_id", F.col("j.parse_ok").alias("parse_ok"), F.col("j.parsed.satisfaction").cast("long").alias("satisfaction"),
        F.col("j.parsed.chunks")[0]["relevance"].cast("long").alias("relevance"), replies.winner(won).alias("winner"),
        replies.score_or(scored, 1, 3, 2).cast("long").alias("score"), replies.unit_score(said).alias("verdict"))


@query("verbosity_trim", """WITH t AS (SELECT doc_id, text AS a, lag(text, 1, text) OVER (ORDER BY doc_id) AS b FROM documents)
SELECT t.doc_id, length(substr(text, 1, cap)) AS kept_a, length(substr(r, 1, cap)) AS kept_b FROM
 (SELECT doc_id, text, reverse(lang || source) AS r, floor(least(length(text), length(lang || source)) * 1.2::DOUBLE)::BIGINT AS cap FROM documents) t""")
def verbosity_trim(spark: SparkSession, sf: str) -> DataFrame:
    a, b = replies.trimmed_pair(F.col("text"), F.reverse(F.concat("lang", "source")))
    return docs(spark, sf).select("doc_id", F.length(a).cast("long").alias("kept_a"), F.length(b).cast("long").alias("kept_b"))


@query("converter_responses", """SELECT doc_id, md5(text) AS text_md5 FROM documents""")
def converter_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Four response shapes of a converter service, one per language, read back to the same text."""
    text, lang = F.col("text"), F.col("lang")
    inner, other = F.struct(text.alias("md_content")), F.struct(text.alias("markdown"))
    shaped = (F.when(lang == "en", F.to_json(inner)).when(lang == "de", F.to_json(other))
              .when(lang == "fr", F.to_json(F.struct(F.array(inner).alias("results")))).otherwise(F.to_json(F.array(other))))
    return docs(spark, sf).select("doc_id", F.md5(replies.markdown_of(shaped)).alias("text_md5"))


@query("knowledge_base_replies", """SELECT conv_id, count(*) AS total_results, md5(string_agg(text, '|' ORDER BY turn) FILTER (turn < 3)) AS texts_md5,
 string_agg(CASE WHEN turn % 2 = 1 THEN 'TEXT' ELSE upper(role) END, ',' ORDER BY turn) FILTER (turn < 3) AS types FROM conversations GROUP BY 1""")
def knowledge_base_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Flat hit lists of a knowledge base in the common shape; turns play hits, every second one has a plain string as content."""
    turn = F.when(F.col("turn") % 2 == 1, F.to_json(F.struct(F.col("text").alias("content"), F.lit(0.5).alias("score")))).otherwise(
        F.to_json(F.struct(F.struct("text", F.upper("role").alias("type")).alias("content"), F.lit(0.5).alias("score"))))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("turn", turn.alias("j")))), lambda x: x["j"])
    raw = tb.table(spark, sf, "conversations").groupBy("conv_id").agg(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")).alias("raw"))
    got = raw.select("conv_id", replies.knowledge_base_reply(F.col("raw"), 3).alias("r"))
    return got.select("conv_id", "r.total_results", F.md5(F.array_join(F.transform("r.content", lambda c: c["text"]), "|")).alias("texts_md5"),
                      F.array_join(F.transform("r.content", lambda c: c["type"]), ",").alias("types"))


@query("json_properties", """SELECT event_type, count(*) AS n, sum((props ->> '$.k')::BIGINT)::BIGINT AS k_total FROM events GROUP BY 1""")
def json_properties(spark: SparkSession, sf: str) -> DataFrame:
    parsed = spread(tb.table(spark, sf, "events")).select("event_type", F.from_json("props", "k long").alias("p"))
    return parsed.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("p.k").alias("k_total"))
