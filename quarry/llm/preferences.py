"""Preference formatting: chosen and rejected conversations as prompt and completions.

Both conversations of a pair are lists of turns.  Their longest common prefix of
turns (equal role and text) is rendered once, as the prompt; what follows on
either side is a completion.  A completion's mask names the stretches that a
loss is taken over: the assistant's texts with their end marks.  DataFrame
operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit("<|end|>"))


def rendered(turns: Column) -> Column:
    """Turns as text; a null role or text counts as empty."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t), F.lit("\n"))), "")


def mask(turns: Column) -> Column:
    """start:end of what the assistant says in ``rendered(turns)``, in code points, comma-joined."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(_head(t))
        end = begin + F.length(_body(t))
        span = F.array(F.concat_ws(":", begin.cast("string"), end.cast("string")))
        return F.struct((end + 1).alias("at"), F.when(F.coalesce(t["role"], F.lit("")) == ASSISTANT, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: F.array_join(acc["spans"], ","))


def common_turns(a: Column, b: Column) -> Column:
    """The number of leading turns that are equal in both lists."""
    same = F.zip_with(a, b, lambda x, y: x.isNotNull() & y.isNotNull() & x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    at = F.array_position(same, F.lit(False)).cast("int")
    return F.when(at == 0, F.size(same)).otherwise(at - 1)


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Format (pair_id, chosen, rejected), the latter two array<struct<role, text, ...>>.

    Other columns are dropped.  Equal conversations give two empty completions; a
    null list counts as an empty one.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    slim = [F.coalesce(F.transform(F.col(c), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))), none).alias(c) for c in ("chosen", "rejected")]
    with_n = pairs.select("pair_id", *slim).withColumn("n_common", common_turns(F.col("chosen"), F.col("rejected")).cast("long"))
    n = F.col("n_common").cast("int")
    rest = lambda c: F.slice(F.col(c), n + 1, F.greatest(F.size(c) - n, F.lit(0)))
    parts = with_n.select("pair_id", "n_common", F.slice("chosen", F.lit(1), n).alias("shared"), rest("chosen").alias("c"), rest("rejected").alias("r"))
    return parts.select(
        "pair_id", "n_common", F.size("c").cast("long").alias("n_chosen"), F.size("r").cast("long").alias("n_rejected"),
        rendered(F.col("shared")).alias("prompt"), rendered(F.col("c")).alias("chosen"), rendered(F.col("r")).alias("rejected"),
        mask(F.col("c")).alias("chosen_mask"), mask(F.col("r")).alias("rejected_mask"),
    )


def last_reply(turns: Column) -> Column:
    """How many turns there are up to the assistant's last, that one included; 0 if it says nothing."""
    return F.coalesce(F.array_max(F.transform(turns, lambda t, i: F.when(F.coalesce(t["role"], F.lit("")) == ASSISTANT, i + 1))), F.lit(0))


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected): one pair for each conversation, in one shuffle.

    The table names no preferences, so another reply is taken from a neighbour: of
    conversations 2i and 2i + 1 each lends the other its last assistant turn.
    Chosen is a conversation up to its last assistant turn; rejected is the same
    with the lent turn in that place, or without any where the neighbour is missing
    or has none.  A conversation without an assistant's turn is both, whole.
    ``pair_id`` is the conversation's id; rows without a conv_id belong to no
    conversation.  Turns go by number, then role, then text, nulls first, so ties
    have one order and repeated rows are repeated turns.  A conversation is one row
    of the result, so it has to fit into one.
    """
    turn = F.struct("turn", "role", "text")
    side = lambda s: F.sort_array(F.collect_list(F.when(F.expr("conv_id & 1") == s, turn)))
    rows = conversations.select("conv_id", "turn", "role", "text").filter(F.col("conv_id").isNotNull())
    both = rows.groupBy(F.shiftright("conv_id", 1).alias("two")).agg(side(0).alias("a"), side(1).alias("b"))
    lent = lambda c: F.get(c, F.when(last_reply(F.col(c)) > 0, last_reply(F.col(c)) - 1))
    one = lambda own, other, s: F.struct((F.shiftleft("two", 1) + s).alias("pair_id"), F.col(own).alias("own"), lent(other).alias("lent"))
    each = both.select(F.explode(F.array(one("a", "b", 0), one("b", "a", 1))).alias("x")).select("x.*").filter(F.size("own") > 0).withColumn("n", last_reply(F.col("own")))
    upto = lambda n: F.when(F.col("n") == 0, F.col("own")).otherwise(F.slice("own", F.lit(1), n))
    reply = F.when((F.col("n") > 0) & F.col("lent").isNotNull(), F.array("lent")).otherwise(F.slice("own", F.lit(1), F.lit(0)))
    return each.select("pair_id", upto(F.col("n")).alias("chosen"), F.concat(upto(F.greatest(F.col("n") - 1, F.lit(0))), reply).alias("rejected"))


def preferences(conversations: DataFrame) -> DataFrame:
    """pair_id, n_common, n_chosen, n_rejected (turns), prompt, chosen, rejected and two masks."""
    return format_pairs(swapped_replies(conversations))


ORACLE = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i, role, text
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT conv_id, coalesce(max(i) FILTER (WHERE role = 'assistant'), 0) AS last FROM t GROUP BY 1),
sides AS (
  SELECT conv_id AS pair_id, 0 AS side, i, role, text FROM t JOIN conv USING (conv_id) WHERE last = 0 OR i <= last
  UNION ALL SELECT conv_id, 1, i, role, text FROM t JOIN conv USING (conv_id) WHERE last = 0 OR i < last
  UNION ALL SELECT c.conv_id, 1, c.last, t.role, t.text FROM conv c JOIN conv o ON o.conv_id = xor(c.conv_id, 1) JOIN t ON t.conv_id = o.conv_id AND t.i = o.last WHERE c.last > 0),
r AS (SELECT *, '<|' || coalesce(role, '') || '|>' || chr(10) AS head, coalesce(text, '') || '<|end|>' AS body FROM sides),
differ AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, min(coalesce(a.i, b.i)) AS i
  FROM (SELECT * FROM r WHERE side = 0) a FULL JOIN (SELECT * FROM r WHERE side = 1) b ON a.pair_id = b.pair_id AND a.i = b.i
  WHERE a.i IS NULL OR b.i IS NULL OR a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text GROUP BY 1),
size_of AS (SELECT pair_id, count(*) FILTER (WHERE side = 0) AS n0, count(*) FILTER (WHERE side = 1) AS n1 FROM r GROUP BY 1),
lcp AS (SELECT pair_id, n0, n1, coalesce(i - 1, n0) AS n FROM size_of LEFT JOIN differ USING (pair_id)),
rest AS (
  SELECT r.*, n, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY pair_id, side, r.i > n ORDER BY r.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS skipped
  FROM r JOIN lcp USING (pair_id))
SELECT pair_id, CAST(n AS BIGINT) AS n_common, CAST(n0 - n AS BIGINT) AS n_chosen, CAST(n1 - n AS BIGINT) AS n_rejected,
  coalesce(string_agg(head || body || chr(10), '' ORDER BY i) FILTER (WHERE side = 0 AND i <= n), '') AS prompt,
  coalesce(string_agg(head || body || chr(10), '' ORDER BY i) FILTER (WHERE side = 0 AND i > n), '') AS chosen,
  coalesce(string_agg(head || body || chr(10), '' ORDER BY i) FILTER (WHERE side = 1 AND i > n), '') AS rejected,
  coalesce(string_agg(CAST(CAST(skipped + length(head) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(skipped + length(head) + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY i) FILTER (WHERE side = 0 AND i > n AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(CAST(CAST(skipped + length(head) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(skipped + length(head) + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY i) FILTER (WHERE side = 1 AND i > n AND role = 'assistant'), '') AS rejected_mask
FROM rest JOIN lcp USING (pair_id, n) GROUP BY pair_id, n, n0, n1
"""
