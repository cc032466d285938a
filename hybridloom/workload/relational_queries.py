"""Join, set and grouping forms that the retrieval operators are made of, on the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.operators import topk
from hybridloom.session import checked_broadcast
from hybridloom.streaming import telemetry
from hybridloom.workload.registry import query
from hybridloom.workload.tables import table


@query("join_inner", """SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    # Orders are summed per customer first, so the join carries one row per customer.
    per_customer = orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("t"))
    joined = per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(checked_broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.sum("n").alias("orders"), F.round(F.sum("t"), 2).alias("total"))


@query("join_left_outer", """SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def join_left_outer(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    rows = table(spark, sf, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"))


@query("join_full_outer", """SELECT coalesce(a.k, b.k) AS nation, a.n AS customers, b.n AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) a
 FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k""")
def join_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("customers"))
    b = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("suppliers"))
    return a.join(b, "nation", "full_outer")


@query("join_semi", "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)")
def join_semi(spark: SparkSession, sf: str) -> DataFrame:
    wanted = table(spark, sf, "lineitem").filter("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf, "part").join(wanted, "p_partkey", "left_semi").select("p_partkey", "p_name")


@query("join_anti", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def join_anti(spark: SparkSession, sf: str) -> DataFrame:
    seen = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(seen, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("join_range", """SELECT p_partkey, count(*) AS near FROM part a JOIN (SELECT p_brand AS brand, p_size AS size FROM part) b ON b.brand = a.p_brand AND abs(b.size - a.p_size) <= 2 GROUP BY 1""")
def join_range(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of the same brand within two sizes: counts per (brand, size) meet five wanted positions, never row by row."""
    part = table(spark, sf, "part")
    sizes = part.groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))
    reach = sizes.select("p_brand", F.col("n"), F.explode(F.sequence(F.col("p_size") - 2, F.col("p_size") + 2)).alias("p_size"))
    near = reach.groupBy("p_brand", "p_size").agg(F.sum("n").alias("near"))
    return part.join(near, ["p_brand", "p_size"]).select("p_partkey", "near")


@query("set_intersect", "SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")).intersect(table(spark, sf, "supplier").select("s_nationkey"))


@query("set_except", "SELECT n_nationkey AS nation FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def set_except(spark: SparkSession, sf: str) -> DataFrame:
    rich = table(spark, sf, "supplier").filter("s_acctbal > 5000").select("s_nationkey")
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation")).subtract(rich)


@query("set_union_distinct", "SELECT lang AS value FROM documents UNION SELECT source FROM documents")
def set_union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select(F.explode(F.array("lang", "source")).alias("value")).distinct()


@query("set_union_all", "SELECT c_nationkey AS nation, 'c' AS side FROM customer UNION ALL SELECT s_nationkey, 's' FROM supplier")
def set_union_all(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.lit("c").alias("side"))
    return a.unionByName(table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("s").alias("side")))


@query("rollup_totals", """SELECT coalesce(l_returnflag, 'all') AS flag, coalesce(l_linestatus, 'all') AS status, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup_totals(spark: SparkSession, sf: str) -> DataFrame:
    out = table(spark, sf, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    return out.select(F.coalesce("l_returnflag", F.lit("all")).alias("flag"), F.coalesce("l_linestatus", F.lit("all")).alias("status"), "n", "quantity")


@query("pivot_counts", """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P",
 count(*) FILTER (o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')) AS other FROM orders GROUP BY 1""")
def pivot_counts(spark: SparkSession, sf: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus").isin("F", "O", "P"), F.col("o_orderstatus")).otherwise("other")
    return table(spark, sf, "orders").withColumn("state", state).groupBy("o_orderpriority").pivot("state", ["F", "O", "P", "other"]).agg(F.count(F.lit(1))).na.fill(0)


@query("distinct_counts", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY 1")
def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_orderpriority").alias("priorities"))


@query("approximate_distinct")
def approximate_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey").alias("parts"), F.percentile_approx("l_quantity", 0.5).alias("median_quantity"))


@query("topk_per_group", """SELECT c_mktsegment, c_custkey, c_acctbal, rn FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn <= 5""")
def topk_per_group(spark: SparkSession, sf: str) -> DataFrame:
    best = topk.topk_per_group(table(spark, sf, "customer"), ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")], 5)
    return best.select("c_mktsegment", "c_custkey", "c_acctbal", F.col("rn").cast("long").alias("rn"))


@query("keep_first", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1")
def keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """First order of every customer as a map-side combined minimum."""
    first = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min_by(F.struct("o_orderkey", "o_totalprice"), F.struct("o_orderdate", "o_orderkey")).alias("f"))
    return first.select("o_custkey", "f.o_orderkey", "f.o_totalprice")


@query("lag_distance", """SELECT user_id, event_id, round(epoch(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)), 3) AS gap FROM events""")
def lag_distance(spark: SparkSession, sf: str) -> DataFrame:
    found = telemetry.gaps(table(spark, sf, "events"), "user_id", "ts", "event_id")
    return found.select("user_id", "event_id", F.round("gap", 3).alias("gap"))


@query("grid_product", """SELECT item_id AS prompt_index, k AS sparse_k, c AS collection FROM benchmark CROSS JOIN (SELECT unnest(range(0, 7)) AS k) CROSS JOIN (SELECT unnest(['splade', 'sae']) AS c)""")
def grid_product(spark: SparkSession, sf: str) -> DataFrame:
    """prompts x sparse_k x collections as two explodes of literal arrays."""
    grid = table(spark, sf, "benchmark").select(F.col("item_id").alias("prompt_index"), F.explode(F.sequence(F.lit(0), F.lit(6))).alias("k"))
    return grid.select("prompt_index", F.col("k").cast("long").alias("sparse_k"), F.explode(F.array(F.lit("splade"), F.lit("sae"))).alias("collection"))


@query("positional_zip", """SELECT vec_id, i - 1 AS pos, (a * b)::DOUBLE AS product FROM (SELECT vec_id, unnest(embedding[1:32])::DOUBLE AS a, unnest(embedding[33:64])::DOUBLE AS b, generate_subscripts(embedding[1:32], 1) AS i FROM embeddings)""")
def positional_zip(spark: SparkSession, sf: str) -> DataFrame:
    halves = F.arrays_zip(F.slice("embedding", 1, 32).alias("a"), F.slice("embedding", 33, 32).alias("b"))
    rows = table(spark, sf, "embeddings").select("vec_id", F.posexplode(halves).alias("pos", "p"))
    return rows.select("vec_id", F.col("pos").cast("long").alias("pos"), (F.col("p.a").cast("double") * F.col("p.b").cast("double")).alias("product"))
