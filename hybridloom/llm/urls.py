"""URL filter: host and path rules first, then logistic regression on hashed character n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridloom.llm.common import digest, sql_digest, table

# The rules as (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

# The small labelled table. Blocked urls, then allowed ones, as host and path.
BLOCKED = """
casino-royal-win.example/en/812 slots-casino.example/jackpot/7 www.online-casino.example/de/6002 m.casino-spins.example/en/12 mega-casino-win.example/fr/44.html
free-bets-daily.example/en/318 best-free-bets.example/en/5 www.sports-bets.example/es/2210 livebets.example/fr/95 blog.poker-bets.example/en/7040 poker-win.example/table/3
cheap-pills-shop.example/en/1021 www.cheap-meds.example/de/58 buy-pills-online.example/en/44 discount-pills.example/cart blog.cheap-viagra.example/es/3301.html pills-cheap.example/en/100
adult-movies.example/en/4100 www.adult-chat.example/fr/77 xxx-adult.example/en/9 m.adult-x-cams.example/de/615 hot-adult-x.example/en/2901 adult-dating.example/sign-up
spam-links-farm.example/en/1 www.link-farm.example/en/530 content-farm-spam.example/en/3 seo-spam.example/fr/8120 blog.spam-blast.example/es/41 web-farm-spam.example/de/9009
ads-tracker.example/en/77 m.track-ads.example/en/4005 adserver-track.example/banner www.ads-click-track.example/es/210 pop-ads.example/en/6413 click-track.example/ads/1
easy-loans-fast.example/en/15 win-free-iphone.example/de/390 crypto-double-money.example/en/7 replica-watches-cheap.example/fr/66 miracle-diet-pills.example/en/88.html
"""
ALLOWED = """
blog.thornton.example/en/12 www.theatre-notes.example/fr/871 library.example/catalogue/42 m.weather-today.example/es/18.html nationals.example/de/7001 thesis-archive.example/en/93
www.cooking-with-herbs.example/recipes/3 history-of-art.example/en/1200 blog.garden-birds.example/posts/77 m.travel-diary.example/fr/64 science-daily.example/articles/9 museum.example/visit
physics-lectures.example/notes/4.html www.city-council.example/minutes/2020 open-maps.example/tiles/8 school-district.example/calendar blog.stationery.example/en/311 www.thirteen.example/es/8
mountain-hiking.example/trails/22 m.orchestra.example/en/450 www.shoreline.example/de/19 river-watch.example/data/6 local-news.example/en/5521 nutrition-facts.example/fr/30
blog.inherited.example/en/8864 www.ontario-farms.example/crops/2 advocates.example/law/7 addition-tables.example/math/3 spanish-lessons.example/es/1 dispatch.example/en/87
www.winter-sports.example/ski/9 alphabet-blocks.example/toys/5 tracking-birds.example/en/77 better-homes.example/plans/6 m.pillars-of-earth.example/book/1 freedom-songs.example/en/40
m.thinness.example/en/3943.html www.redhead.example/en/341 blog.tionesta.example/de/9113.html ththing.example/en/2872 www.etherea.example/fr/9736 therapist.example/en/150 rerun.example/es/96
"""

BLOCK_FROM = 0.6
GRAMS, DIMS, EPOCHS, RATE, DECAY, MOST_LABELLED, INLINE_RULES = (3, 4), 4096, 400, 3.0, 0.0005, 1000, 1000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty for null or without ://."""
    part = lambda i: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))
    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


def _grams(kind: str, value: Column, n: int) -> Column:
    shown = F.concat(F.lit("^"), value, F.lit("$"))
    count = F.length(shown) - (n - 1)
    return F.when((F.length(value) > 0) & (count > 0), F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: (
        digest(F.lit(kind), F.substring(shown, i, F.lit(n))) % DIMS).cast("int"))).otherwise(F.array().cast("array<int>"))


def url_buckets(host: Column, path: Column) -> Column:
    """Distinct hash buckets of the 3- and 4-grams of host and path, with marked ends."""
    return F.array_distinct(F.concat(*[_grams(kind, value, n) for kind, value in (("h", host), ("p", path)) for n in GRAMS]))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: url, label (1 = block)."""
    rows = [(f"http://{u}", label) for urls, label in ((BLOCKED, 1), (ALLOWED, 0)) for u in urls.split()]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{u}', {label})" for u, label in rows) + " AS t(url, label)")


def train_url_filter(labelled: DataFrame, epochs: int = EPOCHS, rate: float = RATE, decay: float = DECAY, most: int = MOST_LABELLED) -> DataFrame:
    """One row with bias and the weights of all buckets, fitted to (url, label) by full-batch gradient descent.

    The weights are a sum of examples, so a step updates one factor per example through their products. The table is small:
    the ``most`` urls of smallest hash are fitted (a documented bound of the fit), rows with a null label are not. An empty table gives bias 0.
    """
    host, path = host_and_path(F.col("url"))
    examples = labelled.where("label IS NOT NULL").groupBy("url").agg(F.max("label").alias("label")).orderBy(digest(F.col("url")), "url").limit(most)
    made = examples.select(F.col("label").cast("double").alias("y"), url_buckets(host, path).alias("x"))
    made = made.withColumn("scale", 1 / F.sqrt(F.greatest(F.size("x"), F.lit(1))))
    whole = made.agg(F.sort_array(F.collect_list(F.struct("x", "y", "scale"))).alias("e"))
    # The products are part of the fold's state: as a column they would be merged into it and computed again in every step.
    products = F.transform("e", lambda a: F.transform("e", lambda b: 1 + F.size(F.array_intersect(a["x"], b["x"])) * a["scale"] * b["scale"]))
    start = F.struct(products.alias("k"), F.transform("e", lambda _: F.lit(0.0)).alias("f"))

    def step(state: Column, _: Column) -> Column:
        def changed(factor: Column, i: Column) -> Column:
            margin = F.aggregate(F.zip_with(state["k"][i], state["f"], lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
            return factor * (1 - rate * decay) - F.lit(rate) * (1 / (1 + F.exp(-margin)) - F.col("e")[i]["y"]) / F.size("e")
        return F.struct(state["k"].alias("k"), F.transform(state["f"], changed).alias("f"))

    fitted = whole.select("e", F.aggregate(F.sequence(F.lit(1), F.lit(epochs)), start, step, lambda state: state["f"]).alias("f"))
    parts = fitted.select(F.explode(F.arrays_zip("e", "f")).alias("r")).select("r.f", "r.e.scale", F.explode("r.e.x").alias("bucket"))
    sums = parts.groupBy("bucket").agg(F.sum(F.col("f") * F.col("scale")).alias("w"))
    every = labelled.sparkSession.range(DIMS).join(sums, F.col("id") == F.col("bucket"), "left").select(F.col("id"), F.coalesce("w", F.lit(0.0)).alias("w"))
    weights = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "w"))), lambda s: s["w"]).alias("weights"))
    bias = fitted.select(F.aggregate("f", F.lit(0.0), lambda s, v: s + v)).scalar()
    return weights.select(bias.alias("bias"), "weights")


def _inline(df: DataFrame, rules: DataFrame) -> DataFrame:
    listed = rules.agg(F.collect_list(F.struct("host", "path", "verdict"))).scalar()
    fits = lambda r: ((F.col("host") == r["host"]) | F.endswith(F.col("host"), F.concat(F.lit("."), r["host"]))) & F.startswith(F.col("path"), r["path"])
    best = F.array_max(F.transform(F.filter("__rules", fits), lambda r: F.struct(
        (F.length(r["host"]) + F.length(r["path"])).alias("n"), F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict"))))
    return df.withColumn("__rules", listed).withColumn("__best", best).drop("__rules")


def _joined(df: DataFrame, rules: DataFrame) -> DataFrame:
    pairs = df.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = pairs.select("host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))).alias("suffix"))
    known = rules.select(F.col("host").alias("suffix"), F.col("path").alias("__start"), "verdict")
    found = suffixes.join(known, "suffix").where(F.startswith("path", "__start"))
    best = found.groupBy("host", "path").agg(F.max(F.struct((F.length("suffix") + F.length("__start")).alias("n"), F.concat("suffix", "__start").alias("rule"), "verdict")).alias("__best"))
    return df.join(best, ["host", "path"], "left")


def judge_urls(df: DataFrame, rules: DataFrame, model: DataFrame, url: str = "url", inline_rules: int = INLINE_RULES) -> DataFrame:
    """``df`` with host, path, rule, score and verdict.

    A rule fits its host and all subdomains when the path starts with the rule's; the longest wins (then the greater in text
    order). Without a rule the classifier decides: block when score >= 0.6 (an unknown host gives no evidence, so more than even odds are asked for). Null urls and urls without :// have empty host and
    path, fit no rule and get the score of the bias. Up to ``inline_rules`` rules are tested inside the row, without a shuffle; larger
    rule tables are joined on the suffixes of the distinct hosts and paths, with equal results. Columns of these names are replaced.
    """
    host, path = host_and_path(F.col(url))
    plain = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
    kept = [c for c in df.columns if c.lower() not in ("host", "path", "rule", "score", "verdict")]
    # Inside, columns go by number, so that none can clash.
    parts = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], host.alias("host"), path.alias("path"))
    few = plain.limit(inline_rules + 1).count() <= inline_rules
    ruled = (_inline if few else _joined)(parts, plain)
    buckets = url_buckets(F.col("host"), F.col("path"))
    scored = ruled.withColumns({"__b": buckets, "__w": model.select("weights").scalar(), "__bias": model.select("bias").scalar()})
    margin = F.col("__bias") + F.aggregate("__b", F.lit(0.0), lambda s, b: s + F.col("__w")[b]) / F.sqrt(F.greatest(F.size("__b"), F.lit(1)))
    scored = scored.withColumn("score", 1 / (1 + F.exp(-margin)))
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "host", "path", F.col("__best.rule").alias("rule"), "score", F.coalesce(
        F.col("__best.verdict"), F.when(F.col("score") >= BLOCK_FROM, "block").otherwise("allow")).alias("verdict"))


def rule_table(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES " + ", ".join(str(r) for r in RULES) + " AS t(host, path, verdict)")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url, judged by the rules and the classifier."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rule_table(spark), train_url_filter(labelled_urls(spark))).select(
        "page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


def _sql_buckets(host: str, path: str) -> str:
    lists = [f"CASE WHEN length({v}) > 0 THEN list_transform(range(1, length({v}) + {4 - n}), lambda i: {sql_digest(f"'{k}'", f"substr('^' || {v} || '$', i, {n})")} % {DIMS}) ELSE []::BIGINT[] END"
             for k, v in (("h", host), ("p", path)) for n in GRAMS]
    return f"list_distinct(flatten([{', '.join(lists)}]))"


def _sql_parts(source: str, extra: str) -> str:
    return f"""(SELECT {extra}, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
      coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM {source})"""


URL_FILTER_SQL = f"""WITH labelled AS (SELECT * FROM (VALUES {', '.join(f"('http://{u}', {label})" for urls, label in ((BLOCKED, 1), (ALLOWED, 0)) for u in urls.split())}) t(url, label)),
  rules AS (SELECT * FROM (VALUES {', '.join(str(r) for r in RULES)}) t(rule_host, rule_path, rule_verdict)),
  examples AS (SELECT label, x, 1 / sqrt(greatest(len(x), 1)) AS scale, row_number() OVER (ORDER BY x, label) AS i
    FROM (SELECT label, {_sql_buckets('host', 'path')} AS x FROM {_sql_parts('labelled', 'label')})),
  fit AS (SELECT list(label::DOUBLE ORDER BY i) AS y, (SELECT list(row ORDER BY i) FROM (SELECT a.i, list(1 + len(list_intersect(a.x, b.x)) * a.scale * b.scale ORDER BY b.i) AS row
    FROM examples a, examples b GROUP BY 1)) AS k FROM examples),
  factors AS (SELECT unnest(range(1, len(y) + 1)) AS i, unnest(list_reduce(list_prepend(list_transform(y, lambda v: 0::DOUBLE), list_transform(range({EPOCHS}), lambda e: []::DOUBLE[])),
      lambda f, e: list_transform(range(1, len(y) + 1), lambda i: f[i] * (1 - {RATE}::DOUBLE * {DECAY}::DOUBLE) - {RATE}::DOUBLE * (1 / (1 + exp(-list_dot_product(k[i], f))) - y[i]) / len(y)))) AS f FROM fit),
  weights AS (SELECT bucket, sum(f * scale) AS w FROM (SELECT f, scale, unnest(x) AS bucket FROM factors JOIN examples USING (i)) GROUP BY 1),
  parts AS {_sql_parts('pages', 'page_id, row_number() OVER () AS n')},
  grams AS (SELECT n, unnest({_sql_buckets('host', 'path')}) AS bucket FROM parts),
  sums AS (SELECT n, sum(coalesce(w, 0)) / sqrt(count(*)) AS s FROM grams LEFT JOIN weights USING (bucket) GROUP BY 1),
  scores AS (SELECT n, 1 / (1 + exp(-((SELECT sum(f) FROM factors) + coalesce(s, 0)))) AS score FROM parts LEFT JOIN sums USING (n)),
  ruled AS (SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY 1)
  SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN score >= {BLOCK_FROM} THEN 'block' ELSE 'allow' END) AS verdict, round(score, 6) AS score
  FROM parts JOIN scores USING (n) LEFT JOIN ruled USING (n)"""
