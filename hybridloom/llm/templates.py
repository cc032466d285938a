"""Main text of web pages: subtrees that recur across the pages of a host are its template and go."""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hybridloom.llm.common import broadcast_if_small, free_name, table, written
from hybridloom.llm.urls import host_and_path

LEAST_PAGES, LEAST_SHARE = 3, 0.1

# Fixed values of the markup language: elements by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
MAIN = frozenset(("article", "main"))
# A start tag ends open elements of these kinds, up to the nearest element of the second kind.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)),
        "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
# Elements that never show text of the page, and elements, roles and words of class and id that hint at chrome.
SILENT_TAGS = frozenset("""button canvas datalist embed form head iframe input noembed noframes noscript object option script select style svg template textarea
    title""".split())
CHROME_TAGS = frozenset("aside dialog fieldset footer menu nav".split())
CHROME_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
CHROME_WORDS = frozenset("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer menu modal nav
    navbar navigation newsletter notice notification popup promo promoted recommended related share sharing sidebar social sponsor sponsored subscribe
    subscription toolbar widget""".split())
SITE_HEADER = frozenset(("header", "masthead"))

_TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:-->|--!>|$))|<(/?)([a-zA-Z][^\s/>]*)((?:[^'">]|"[^"]*"|'[^']*')*?)(/?)>|<[!?/][^>]*>|<[a-zA-Z/!?][^>]*\Z""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.S)
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


@dataclass
class Node:
    tag: str
    parent: int
    silent: bool  # it or an element around it never shows text
    inside: bool  # of an article or main element
    chrome: int = 0  # hash of tag, class and id where these hint at chrome
    key: list[str] = field(default_factory=list)
    mark: int = 0


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text.strip() else {}


def _silent(tag: str, attributes: dict[str, str]) -> bool:
    return tag in SILENT_TAGS or "hidden" in attributes or attributes.get("aria-hidden") == "true"


def _hints(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    if tag in CHROME_TAGS or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body") or tag in MAIN:
        return False
    words = set(_WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()))
    return attributes.get("role", "").lower() in CHROME_ROLES or bool(words & CHROME_WORDS) or (not inside and bool(words & SITE_HEADER))


def parse(html: str | None) -> tuple[list[Node], list[tuple[int, str | None]]]:
    """Elements in order of their start tags, each with a hash of its subtree, and the text: (element, text), text None where a
    block begins or ends. Open elements end where HTML lets them end, at the latest with the page; a cut tag at the end is dropped."""
    page = html or ""
    nodes, events, stack = [Node("", -1, False, False)], [], [0]
    open_at: dict[str, list[int]] = {}  # by tag: the depths at which such elements are open
    nearest = lambda tags: max((open_at[t][-1] for t in tags if open_at.get(t)), default=0)

    def close(upto: int) -> None:
        while len(stack) > upto:
            node = nodes[stack.pop()]
            open_at[node.tag].pop()
            node.mark = _hash("\x1f".join(node.key))
            nodes[stack[-1]].key.append(str(node.mark))
            if node.tag in BLOCK:
                events.append((stack[-1], None))

    def text(value: str) -> None:
        value = entities.unescape(value)
        events.append((stack[-1], value))
        plain = " ".join(value.split())
        if plain:
            nodes[stack[-1]].key.append(plain)

    at = 0
    while at < len(page):
        token = _TOKEN.search(page, at)
        if token is None:
            text(page[at:])
            break
        if token.start() > at:
            text(page[at:token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            depth = nearest((tag,))
            if depth:
                close(depth)
            continue
        kinds, bounds = ENDS.get(tag, ((), ()))
        if tag in BLOCK and tag not in ENDS:
            kinds, bounds = ("p",), ("table", "button", "td", "th")
        depth = nearest(kinds)
        if depth > nearest(bounds):
            close(depth)
        attributes = _attributes(token[3])
        above = nodes[stack[-1]]
        shape = " ".join([tag, attributes.get("class", ""), attributes.get("id", "")])
        node = Node(tag, stack[-1], above.silent or _silent(tag, attributes), above.inside or tag in MAIN)
        if _hints(tag, attributes, above.inside):
            node.chrome = _hash(_DIGITS.sub("0", shape)) or 1
        node.key.append(shape)
        if tag in BLOCK or tag == "br":
            events.append((stack[-1], None if tag in BLOCK else " "))
        if tag in VOID:
            continue
        nodes.append(node)
        open_at.setdefault(tag, []).append(len(stack))
        stack.append(len(nodes) - 1)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            close(len(stack) - 1)
            if end:
                at = page.find(">", at) + 1 or len(page)
    close(1)
    return nodes, events


def _removable(node: Node) -> bool:
    """Blocks that may be a template when they recur as they are: all outside of article and main elements, which are protected."""
    return node.tag in BLOCK and not node.inside and node.tag not in ("html", "body") and len(node.key) > 1


def main_text(html: str | None, template: frozenset[int] | set[int] = frozenset(), counted: bool = False) -> str:
    """Text of the page without the subtrees of ``template``; only where the site was not ``counted``, elements that hint at chrome go unseen."""
    return _text(*parse(html), template, counted)


def _text(nodes: list[Node], events: list[tuple[int, str | None]], template: frozenset[int] | set[int], counted: bool) -> str:
    gone = [False] * len(nodes)
    for i, node in enumerate(nodes):
        gone[i] = ((node.parent >= 0 and gone[node.parent]) or node.silent or (node.chrome != 0 and (not counted or node.chrome in template))
                   or (node.mark in template and _removable(node)))
    return " ".join("".join(" " if value is None else value for owner, value in events if not gone[owner]).split())


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, mark, chrome, page): the subtrees of each page by content, elements that hint at chrome by tag, class and id, and null for the page
    itself; page is a hash of its text without either."""
    for batch in batches:
        rows: set[tuple] = set()
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
            nodes, events = parse(html.as_py())
            page = _hash(_text(nodes, events, frozenset(), False))
            rows.add((host, None, False, page))
            rows.update((host, n.mark, False, page) for n in nodes if not n.silent and _removable(n))
            rows.update((host, n.chrome, True, page) for n in nodes if n.chrome and not n.silent)
        hosts, marks, chrome, pages = zip(*rows) if rows else ((),) * 4
        yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(marks, pa.int64()), pa.array(chrome, pa.bool_()), pa.array(pages, pa.int64())],
                              names=["host", "mark", "chrome", "page"])


def host_templates(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, marks) of hosts with ``least_pages`` different pages: hashes of their recurring subtrees.

    A subtree recurs by its content, if at least ``least_pages`` and ``least_share`` of the host's different pages hold it, or, where its element,
    role, class or id hints at chrome, by tag, class and id alone (digits alike) on at least ``least_pages`` of them: menus, adverts and footers with dates
    or teasers differ in their texts. Article and main elements are no template. ``pages`` has host and html. Pages of a host with equal texts
    without chrome are copies of one page, which counts once for a subtree however often it is there. Copies are combined before the shuffle, and
    the rows of a host are spread over its pages. At most 1 / least_share subtrees per subtree of a page can recur so often.
    """
    held = pages.select("host", "html").mapInArrow(_marks, "host string, mark long, chrome boolean, page long").distinct()
    counts = written(held.groupBy("host", "mark", "chrome").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages), "page-subtrees")
    totals = counts.where("mark IS NULL").select("host", F.col("n").alias("pages"))
    joined = counts.join(broadcast_if_small(totals, 128), "host")
    frequent = joined.where(F.col("mark").isNull() | F.col("chrome") | (F.col("n") >= least_share * F.col("pages")))
    return frequent.groupBy("host").agg(F.collect_set("mark").alias("marks"))


def extract_text(pages: DataFrame, url: str = "url", html: str = "html", **options) -> DataFrame:
    """``pages`` with text, the main text of the whole ``html``.

    What recurs on a host (see :func:`host_templates`) goes, and what never shows text: scripts, styles, forms, hidden elements, the head. Nothing else
    does, so text outside of article and main elements stays unless it is a template. Null and empty pages give an empty text. Pages without a host, and those
    of hosts with fewer than ``least_pages`` different pages, have no counts to go by; there every element that hints at chrome goes. Repeated pages give a
    row each. A column named text is replaced.
    """
    kept = [c for c in pages.columns if c.lower() != "text"]
    host, marks = free_name(pages, "host"), free_name(pages, "marks")
    plain = pages.select(*[F.col(f"`{c}`") for c in kept])
    sited = plain.withColumn(host, host_and_path(F.col(f"`{url}`"))[0])
    known = sited.where(F.col(host) != "").select(F.col(host).alias("host"), F.col(f"`{html}`").alias("html"))
    side = host_templates(known, **options).select(F.col("host").alias(host), F.col("marks").alias(marks))
    joined = sited.join(broadcast_if_small(side, 4096), host, "left").select(*[F.col(f"`{c}`") for c in kept], marks)
    place = kept.index(html)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_sets: dict[tuple, frozenset[int]] = {}
        for batch in batches:
            texts = []
            for page, template in zip(batch.column(place), batch.column(len(kept))):
                values = tuple(template.as_py() or ())
                if values not in known_sets:
                    if len(known_sets) > 1000:
                        known_sets.clear()
                    known_sets[values] = frozenset(values)
                texts.append(main_text(page.as_py(), known_sets[values], template.is_valid))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*kept, "text"])

    schema = StructType([*plain.schema.fields, StructField("text", StringType())])
    return joined.mapInArrow(extracted, schema)


def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
