"""Preference formatting: a chosen and a rejected conversation as one prompt and two masked completions.

The prompt is the longest common prefix of turns, rendered once.  What follows in each conversation is its
completion.  The mask of a completion lists the character spans to learn from: the texts of assistant turns, each
with its end mark.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"


def _heading(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit(CLOSE))


def _turn(turn: Column) -> Column:
    return F.concat(_heading(turn), F.coalesce(turn["text"], F.lit("")), F.lit(END))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _turn), "")


def spans(turns: Column) -> Column:
    """``from`` and ``to`` (exclusive), in characters of the rendered turns, of what assistant turns say."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<`from`:int,`to`:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_heading(turn))
        stop = state["at"] + F.length(_turn(turn))
        span = F.struct(begin.alias("from"), (stop - 1).alias("to"))  # the end mark without its line end
        learned = F.coalesce(turn["role"] == LEARNED, F.lit(False))
        return F.struct(
            stop.alias("at"), F.when(learned, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans")
        )

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """How many leading turns are equal in role and text; nulls are equal to each other."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    differs = F.array_position(same, False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(same)).cast("int")


def preferences(pairs: DataFrame) -> DataFrame:
    """Pairs with ``n_prompt_turns, prompt, chosen_text, rejected_text, chosen_spans, rejected_spans`` for their arrays.

    ``chosen`` and ``rejected`` are arrays of turns with ``role`` and ``text``; all other columns are kept.  A null
    role or text is rendered as empty and is equal only to another null.  A null array is as an empty one.  Equal
    conversations give two empty completions.  A completion without assistant turns has no spans.
    """
    turn = "array<struct<role:string,text:string>>"
    plain = pairs.select(
        *[x for x in pairs.columns if x not in ("chosen", "rejected")],
        *[F.coalesce(F.transform(x, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))), F.array().cast(turn)).alias(x)
          for x in ("chosen", "rejected")],
    ).withColumn("n_prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))
    after = lambda x: F.slice(x, F.col("n_prompt_turns") + 1, F.greatest(F.size(x) - F.col("n_prompt_turns"), F.lit(0)))
    parts = plain.select(
        "*", rendered(F.slice("chosen", F.lit(1), F.col("n_prompt_turns"))).alias("prompt"),
        after("chosen").alias("c"), after("rejected").alias("r"),
    )
    return parts.select(
        *[x for x in plain.columns if x not in ("chosen", "rejected")], "prompt",
        rendered(F.col("c")).alias("chosen_text"), rendered(F.col("r")).alias("rejected_text"),
        spans(F.col("c")).alias("chosen_spans"), spans(F.col("r")).alias("rejected_spans"),
    )


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, equal rows once; rows without a conv_id are left out."""
    rows = turns.filter(F.col("conv_id").isNotNull()).select("conv_id", F.struct("turn", "role", "text").alias("t"))
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_set("t")).alias("t"))
    return gathered.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def swapped_replies(turns: DataFrame) -> DataFrame:
    """``conv_id, chosen, rejected``: pairs made from conversations that carry no preferences.

    Conversations 2k and 2k + 1 answer for each other: up to its last assistant turn a conversation is chosen, and
    the same turns ending with its partner's last assistant turn are rejected.  A conversation without an assistant
    turn, or whose partner has none, gives no pair.
    """
    whole = conversations(turns)
    at = F.expr(f"size(turns) - array_position(reverse(transform(turns, t -> t.role <=> '{LEARNED}')), true) + 1")
    ended = whole.filter(F.exists("turns", lambda t: t["role"].eqNullSafe(LEARNED)))
    ended = ended.select("conv_id", F.slice("turns", F.lit(1), at.cast("int")).alias("chosen"))
    reply = ended.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.element_at("chosen", -1).alias("other"))
    before = F.slice("chosen", F.lit(1), F.size("chosen") - 1)
    return ended.join(reply, "conv_id").select("conv_id", "chosen", F.concat(before, F.array("other")).alias("rejected"))


def spans_text(column: str) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws("-", s["from"].cast("string"), s["to"].cast("string"))), ",")


SQL = """
WITH rows AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM rows),
ended AS (SELECT conv_id, max(n) AS n FROM numbered WHERE role = 'assistant' GROUP BY conv_id),
final AS (SELECT conv_id, n, text FROM numbered JOIN ended USING (conv_id, n)),
pair AS (
  SELECT a.conv_id, a.n, a.text AS good, b.text AS bad, a.text IS NOT DISTINCT FROM b.text AS same
  FROM final a JOIN final b ON b.conv_id = xor(a.conv_id, 1)),
prompt AS (
  SELECT conv_id, coalesce(string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), ''
      ORDER BY t.n) FILTER (t.n < p.n OR same), '') AS prompt
  FROM pair p JOIN numbered t USING (conv_id) WHERE t.n <= p.n GROUP BY conv_id)
SELECT conv_id, (n - 1 + same::INT)::INT AS n_prompt_turns, prompt,
  CASE WHEN same THEN '' ELSE '<|assistant|>' || chr(10) || coalesce(good, '') || '<|end|>' || chr(10) END AS chosen_text,
  CASE WHEN same THEN '' ELSE '<|assistant|>' || chr(10) || coalesce(bad, '') || '<|end|>' || chr(10) END AS rejected_text,
  CASE WHEN same THEN '' ELSE '14-' || (14 + length(coalesce(good, '')) + 7)::VARCHAR END AS chosen_spans,
  CASE WHEN same THEN '' ELSE '14-' || (14 + length(coalesce(bad, '')) + 7)::VARCHAR END AS rejected_spans
FROM pair JOIN prompt USING (conv_id)
"""
