"""Spelling variants: words one edit apart, found by walking a trie of all words level by level as joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridloom.llm.common import broadcast_if_small, table, written

LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 6, 5, 5
# A code point is lost where the hash of document and word is a multiple of this.
LOSS = 199
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Fixed value of the contract: letters of words.
LETTERS = "[A-Za-zÀ-ÿ]+"
# A trie edge is at most this wide when its size is checked for a broadcast.
_EDGE_BYTES = 96


def _node(side: Column, prefix: Column) -> Column:
    """64-bit name of a trie node. Two prefixes of one name only add states: every hit is compared letter by letter in the end."""
    return F.xxhash64(side, prefix)


def word_trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths and edges of the tries of all words (side 0) and of all words read backwards (side 1).

    ``words`` has one column, word, without repeats. Nodes with one way on are merged into their edge, so an edge's label has one or more
    letters. Paths: (side, key, cuts), the depths of a word's nodes. Edges: (node, label, child, target, nexts), target
    being the word that ends at the child and nexts the first letters that lead on from there. A node has at most an alphabet of edges.
    """
    keys = words.select(F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("key")),
                                          F.struct(F.lit(1).alias("side"), F.reverse("word").alias("key")))).alias("k")).select("k.side", "k.key")
    size = F.length("key")
    prefixes = keys.select("side", "key", F.explode(F.sequence(F.lit(1), size)).alias("d"))
    prefixes = prefixes.select("side", "key", "d", _node(F.col("side"), F.expr("substring(key, 1, d)")).alias("node"), F.expr("substring(key, d + 1, 1)").alias("letter"))
    on = F.when(F.col("letter") != "", F.col("letter"))
    ways = prefixes.groupBy("node").agg(F.min(on).alias("low"), F.max(on).alias("high"), F.max(F.col("letter") == "").alias("ends"))
    forks = ways.where("low IS NOT NULL AND (low <> high OR ends)").select("node")
    inner = prefixes.where(F.col("letter") != "").join(forks, "node", "left_semi").select("side", "key", "d")
    paths = inner.union(keys.select("side", "key", size.alias("d"))).groupBy("side", "key").agg(F.concat(F.array(F.lit(0)), F.sort_array(F.collect_set("d"))).alias("cuts"))
    paths = written(paths, "trie-paths")
    steps = paths.select("side", "key", F.explode(F.arrays_zip(F.expr("slice(cuts, 1, size(cuts) - 1)").alias("a"), F.expr("slice(cuts, 2, size(cuts) - 1)").alias("b"))).alias("s"))
    steps = steps.select(_node(F.col("side"), F.expr("substring(key, 1, s.a)")).alias("node"), F.expr("substring(key, s.a + 1, s.b - s.a)").alias("label"),
                         _node(F.col("side"), F.expr("substring(key, 1, s.b)")).alias("child"), F.when(F.col("s.b") == size, F.col("key")).alias("target"))
    edges = written(steps.groupBy("node", "label", "child").agg(F.max("target").alias("target")), "trie-steps")
    nexts = edges.groupBy(F.col("node").alias("at")).agg(F.array_join(F.sort_array(F.collect_set(F.expr("substring(label, 1, 1)"))), "").alias("nexts"))
    edges = edges.join(nexts, F.col("child") == F.col("at"), "left").select("node", "label", "child", "target", F.coalesce("nexts", F.lit("")).alias("nexts"))
    return paths, written(edges, "trie-edges")


def _level(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States one edge further on: (side, key, pos, node, edits, target), target set where a word one edit away is complete.

    A state without an edit tries every edge of its node; one with its edit follows the only edge that goes on with its next letter. The edit is placed
    where word and edge first differ, in the second half of the word; differences in the first half are met on the other side.
    """
    met = states.join(edges, "node")
    size, label, pos = F.length("key"), F.col("label"), F.col("pos")
    length = F.length(label)
    met = met.withColumns({"rest": F.expr("substring(key, pos + 1)"), "size": size, "l": length})
    met = met.withColumn("whole", F.col("rest").startswith(label)).where(F.expr("edits = 0 OR whole"))
    half = F.expr("greatest(int((size - 1) / 2) - pos, 0)")
    turned = F.expr("edits = 0 AND NOT whole") & (F.substring("rest", F.lit(1), half) == F.substring("label", F.lit(1), half)) & (half < length)
    near = lambda taken: (F.length("rest") >= taken) & (F.levenshtein(F.substring("rest", F.lit(1), taken), label, 1) == 1)
    moves = [(F.expr("edits = 0 AND whole AND nexts <> ''"), length, 0, False), (F.expr("edits = 0 AND whole AND target IS NOT NULL AND pos + l = size - 1"), length, 1, True),
             (F.expr("edits = 1 AND whole"), length, 1, None), (turned & near(length), length, 1, None),
             (turned & near(length - 1), length - 1, 1, None), (turned & near(length + 1), length + 1, 1, None)]
    options = [F.when(when, F.struct((pos + taken).alias("pos"), F.lit(edits).alias("edits"), F.lit(done).cast("boolean").alias("done"))) for when, taken, edits, done in moves]
    out = met.select("side", "key", "child", "target", "nexts", "size", F.explode(F.array(*options)).alias("m")).where("m IS NOT NULL")
    # With its edit made, a state lives on only if it is complete or an edge goes on with its next letter.
    out = out.withColumn("done", F.coalesce(F.col("m.done"), F.expr("m.pos = size AND target IS NOT NULL")))
    out = out.where(F.expr("m.edits = 0 OR done OR (m.pos < size AND instr(nexts, substring(key, m.pos + 1, 1)) > 0)"))
    return out.select("side", "key", F.col("m.pos").alias("pos"), F.col("child").alias("node"), F.col("m.edits").alias("edits"), F.when(F.col("done"), F.col("target")).alias("target"))


def near_words(words: DataFrame, word: str = "word") -> DataFrame:
    """(word, near): all ordered pairs of different words that one inserted, deleted or replaced code point turns into each other.

    Null and empty words take no part, repeated words count once, an empty table gives an empty one. Two words at distance one agree up to the edit
    and after it, so from the half of a word that agrees the walk needs only the edges of one node a level: the frontier begins at
    the deepest node in a word's first half, on the words as they are and backwards. Each level is a join with the edge table
    (broadcast only if its size is checked) and is written before the next.
    """
    plain = written(words.select(F.col(word).alias("word")).where("word <> ''").distinct(), "words")
    paths, edges = word_trie(plain)
    edges = broadcast_if_small(edges, _EDGE_BYTES)
    begin = F.expr("array_max(filter(cuts, c -> c <= int((length(key) - 1) / 2)))")
    states = paths.select("side", "key", begin.alias("pos"))
    states = states.select("side", "key", "pos", _node(F.col("side"), F.expr("substring(key, 1, pos)")).alias("node"), F.lit(0).alias("edits"))
    hits = []
    while True:
        level = written(_level(states, edges), "trie-level")
        hits.append(level.where("target IS NOT NULL").select("side", "key", "target"))
        states = level.where("target IS NULL").drop("target")
        if states.isEmpty():
            break
    met = reduce(DataFrame.union, hits)
    turned = lambda c: F.when(F.col("side") == 1, F.reverse(c)).otherwise(F.col(c))
    pairs = met.select(turned("key").alias("word"), turned("target").alias("near")).where(F.levenshtein("word", "near", 1) == 1)
    return pairs.distinct()


def variant_forms(counts: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of ``counts`` (word, n), a row for each word.

    form is the near word of largest n, ties to the smallest in code-point order, if its n is at least ``factor`` times the word's; root is where
    the forms lead in the end. Counts grow along the way, so it ends; the way is halved by each round of joins. Repeated words
    count as one with the sum of their counts; null and empty words give no row, null counts none.
    """
    words = written(counts.where("word <> ''").groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), "counts")
    pairs = near_words(words.select("word"))
    known = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = known.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    judged = words.join(best, "word", "left").withColumn("fits", F.coalesce(-F.col("best.less") >= factor * F.col("n"), F.lit(False)))
    judged = written(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("fits"), F.col("best.near")).alias("form"),
                                   F.when(F.col("fits"), -F.col("best.less")).alias("form_n")), "forms")
    ways = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        ways = written(ways.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if ways.where("moved").isEmpty():
            break
        ways = ways.drop("moved")
    return judged.join(ways.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def word_occurrences(docs: DataFrame) -> DataFrame:
    """(word, n) of the contract: lower-cased letter runs of whole texts, some with a letter lost; null texts have none, null ids count as empty strings."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("run")).where(F.length("run") >= LEAST_LENGTH)
    plain = F.length("run") == F.octet_length("run")
    runs = runs.withColumn("run", F.when(plain, F.lower("run")).otherwise(F.translate("run", _UPPER, _UPPER.lower())))
    runs = runs.withColumn("h", F.crc32(F.encode(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")), "UTF-8")))
    lost = F.expr("concat(substring(run, 1, int(h % length(run))), substring(run, int(h % length(run)) + 2))")
    words = runs.select(F.when(F.col("h") % LOSS == 0, lost).otherwise(F.col("run")).alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    found = variant_forms(word_occurrences(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select("word", "n", "n_near", "form", "form_n", "root")


SPELLING_VARIANTS_SQL = f"""WITH RECURSIVE crc_table AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(
    list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b))),
  runs AS (SELECT doc_id, translate(run, '{_UPPER}', '{_UPPER.lower()}') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) WHERE length(run) >= {LEAST_LENGTH} GROUP BY 1, 2),
  hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)))::BIGINT AS h FROM runs, crc_table),
  words AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % {LOSS} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
    WHERE length(word) >= {LEAST_LENGTH} GROUP BY 1 HAVING sum(n) >= {LEAST_COUNT}),
  less AS (SELECT word, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS v FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
  shorter AS (SELECT DISTINCT l.word, w.word AS near FROM less l JOIN words w ON l.v = w.word),
  pairs AS (SELECT a.word, b.word AS near FROM less a JOIN less b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
    UNION SELECT word, near FROM shorter UNION SELECT near, word FROM shorter),
  best AS (SELECT p.word, count(*) AS n_near, arg_min(p.near, (-w.n, p.near)) AS near, max(w.n) AS near_n FROM pairs p JOIN words w ON p.near = w.word GROUP BY 1),
  forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {FORM_FACTOR} * n THEN near END AS form, CASE WHEN near_n >= {FORM_FACTOR} * n THEN near_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word),
  ways AS (SELECT word, word AS root FROM forms UNION ALL SELECT y.word, f.form FROM ways y JOIN forms f ON y.root = f.word WHERE f.form IS NOT NULL)
  SELECT f.word, f.n, f.n_near, f.form, f.form_n, y.root FROM forms f JOIN ways y ON f.word = y.word JOIN forms g ON y.root = g.word AND g.form IS NULL"""
