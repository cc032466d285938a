"""Preference formatting: one prompt for the turns two conversations share, and a masked completion for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridloom.llm.common import table

# Markers of the rendered form. A "<|" inside a text is written "<||", so no text can forge a marker and rendering can be undone.
OPEN, CLOSE, END = "<|", "|>", "<|end|>"
TRAINED_ROLE = "assistant"
TURN = "array<struct<role:string,text:string>>"


def _role(turn: Column) -> Column:
    return F.replace(F.coalesce(turn["role"], F.lit("")), F.lit(OPEN), F.lit(OPEN + "|"))


def _body(turn: Column) -> Column:
    return F.concat(F.replace(F.coalesce(turn["text"], F.lit("")), F.lit(OPEN), F.lit(OPEN + "|")), F.lit(END))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _role(turn), F.lit(CLOSE))


def render(turns: Column) -> Column:
    """The turns as one text: <|role|>text<|end|> for each."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def trained_spans(turns: Column) -> Column:
    """Code point spans [start, end) of the rendered text that count for the loss: bodies of assistant turns with their end marker."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_head(turn))
        end = (begin + F.length(_body(turn))).cast("long")
        span = F.array(F.struct(begin.cast("long").alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.coalesce(turn["role"] == TRAINED_ROLE, F.lit(False)), F.concat(state["spans"], span))
                        .otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def format_preferences(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` with the longest common turn prefix rendered once and the two remainders as masked completions.

    ``chosen`` and ``rejected`` are arrays of (role, text); null arrays count as empty, null roles and texts as empty strings,
    but a null turn field equals only a null one. Adds n_common (turns shared), prompt, chosen_completion, chosen_spans,
    rejected_completion and rejected_spans; equal conversations have two empty completions. Other columns stay; columns of
    these names are replaced. Everything happens inside the row: no shuffle, and long conversations cost time in their length alone.
    """
    empty = F.array().cast(TURN)
    a, b = (F.coalesce(F.col(c).cast(TURN), empty) for c in (chosen, rejected))
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    common = F.when(differs > 0, differs - 1).otherwise(F.size(a)).cast("int")
    made = pairs.withColumn("n_common", common)
    rest = lambda turns: F.slice(turns, F.col("n_common") + 1, F.size(turns))
    return made.withColumns({"prompt": render(F.slice(a, 1, F.col("n_common"))),
                             "chosen_completion": render(rest(a)), "chosen_spans": trained_spans(rest(a)),
                             "rejected_completion": render(rest(b)), "rejected_spans": trained_spans(rest(b))})


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) in turn order. Repeated rows count once; rows that share a number are ordered by role and text; rows
    without a conv_id belong to no conversation."""
    ordered = F.sort_array(F.collect_set(F.struct("turn", "role", "text")))
    return turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["role"], t["text"])).cast(TURN).alias("turns"))


def rival_pairs(turns: DataFrame) -> DataFrame:
    """A preference pair for each conversation: its own last reply is preferred to the last reply of its neighbour.

    The neighbour of 2k is 2k + 1 and the other way round. chosen ends with the last assistant turn; rejected has the same turns
    before it. Without an own reply there are no completions to compare (both sides hold all turns); without a neighbour's
    reply rejected stops before the reply.
    """
    whole = conversations(turns)
    place = F.aggregate(F.sequence(F.lit(1), F.size("turns")), F.lit(0), lambda last, i: F.when(
        F.coalesce(F.element_at(F.col("turns"), i)["role"] == TRAINED_ROLE, F.lit(False)), i).otherwise(last))
    placed = whole.withColumn("reply_at", place)
    replies = placed.where("reply_at > 0").select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.slice("turns", F.col("reply_at"), 1).alias("rival"))
    joined = placed.join(replies, "conv_id", "left")
    before = F.slice("turns", 1, F.greatest(F.col("reply_at") - 1, F.lit(0)))
    return joined.select("conv_id", F.when(F.col("reply_at") > 0, F.slice("turns", 1, F.col("reply_at"))).otherwise(F.col("turns")).alias("chosen"),
                         F.when(F.col("reply_at") > 0, F.concat(before, F.coalesce("rival", F.array().cast(TURN)))).otherwise(F.col("turns")).alias("rejected"))


def op10_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's preference pair, rendered and masked."""
    spans = lambda c: F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"]))
    return format_preferences(rival_pairs(table(spark, sf_dir, "conversations"))).select(
        "conv_id", "n_common", "prompt", "chosen_completion", F.array_join(spans(F.col("chosen_spans")), ",").alias("chosen_spans"),
        "rejected_completion", F.array_join(spans(F.col("rejected_spans")), ",").alias("rejected_spans"))


_SHOWN = "'<|' || replace(coalesce(t.role, ''), '<|', '<||') || '|>'"
_TEXT = "replace(coalesce(t.text, ''), '<|', '<||') || '<|end|>'"


def _sql_side(name: str, source: str) -> str:
    return f"""{name} AS (SELECT conv_id, string_agg(head || body, '' ORDER BY n) FILTER (n > n_common) AS completion,
      string_agg((upto - length(body)) || '-' || upto, ',' ORDER BY n) FILTER (n > n_common AND role = '{TRAINED_ROLE}') AS spans
      FROM (SELECT *, sum(length(head) + length(body)) FILTER (n > n_common) OVER (PARTITION BY conv_id ORDER BY n) AS upto
        FROM (SELECT t.*, {_SHOWN} AS head, {_TEXT} AS body, n_common FROM {source} t JOIN common USING (conv_id))) GROUP BY 1)"""


PREFERENCE_PAIRS_SQL = f"""WITH turns AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n
    FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)),
  reply AS (SELECT conv_id, max(n) AS here FROM turns WHERE role = '{TRAINED_ROLE}' GROUP BY 1),
  chosen AS (SELECT t.* FROM turns t LEFT JOIN reply r USING (conv_id) WHERE here IS NULL OR n <= here),
  rejected AS (SELECT t.* FROM turns t LEFT JOIN reply r USING (conv_id) WHERE here IS NULL OR n < here
    UNION ALL SELECT own.conv_id, t.role, t.text, own.here FROM reply own JOIN reply other ON other.conv_id = xor(own.conv_id, 1)
      JOIN turns t ON t.conv_id = other.conv_id AND t.n = other.here),
  common AS (SELECT conv_id, coalesce(min(n) FILTER (NOT same) - 1, max(n)) AS n_common FROM (SELECT conv_id, n,
      a.n IS NOT NULL AND b.n IS NOT NULL AND a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text AS same
      FROM chosen a FULL JOIN rejected b USING (conv_id, n)) GROUP BY 1),
  prompts AS (SELECT conv_id, string_agg({_SHOWN} || {_TEXT}, '' ORDER BY n) AS prompt FROM chosen t JOIN common USING (conv_id) WHERE n <= n_common GROUP BY 1),
  {_sql_side('good', 'chosen')}, {_sql_side('bad', 'rejected')}
  SELECT conv_id, n_common::INT AS n_common, coalesce(prompt, '') AS prompt, coalesce(g.completion, '') AS chosen_completion,
    coalesce(g.spans, '') AS chosen_spans, coalesce(b.completion, '') AS rejected_completion, coalesce(b.spans, '') AS rejected_spans
  FROM common LEFT JOIN prompts USING (conv_id) LEFT JOIN good g USING (conv_id) LEFT JOIN bad b USING (conv_id)"""
