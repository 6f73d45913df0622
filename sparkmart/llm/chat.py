"""Operator 3 - preference formatting of chosen and rejected conversations.

For each pair the longest common prefix of turns (equal role and text) is rendered
once as the prompt; what follows on either side is a completion.  A completion's mask
is a list of runs (length in characters, loss 0 or 1) that covers it from its start:
the text and end mark of assistant turns count for the loss, headers and other turns
do not.  DataFrame functions only; one shuffle by pair.

A pair's turns come together in one row, as its rendered text has to: a conversation
is one training example.  Rows of different pairs never meet.

Defined cases: rows with a null pair or an unknown side are left out (they belong to
no pair); a null turn number comes first, a null role is empty, a null text is empty;
rows with equal turn numbers are ordered by role and text, repeated rows are turns of
their own; a side without turns has an empty completion; equal sides have empty
completions and everything in the prompt; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A rendered turn: head, role, middle, text, end.
HEAD, MIDDLE, END = "<|", "|>\n", "<|end|>\n"


def _rendered(turns: Column) -> Column:
    one = lambda t: F.concat(F.lit(HEAD), t["role"], F.lit(MIDDLE), t["text"], F.lit(END))
    return F.array_join(F.transform(turns, one), "")


def _mask(turns: Column, trained: str) -> Column:
    """Runs (length, loss) over the rendered turns."""
    run = lambda n, loss: F.struct(n.cast("int").alias("length"), loss.cast("int").alias("loss"))
    return F.flatten(F.transform(turns, lambda t: F.array(
        run(F.length(t["role"]) + len(HEAD) + len(MIDDLE), F.lit(0)),
        run(F.length(t["text"]) + len(END), F.when(t["role"] == trained, 1).otherwise(0)))))


def format_preferences(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """(pair_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask) from (pair_id, side, turn, role, text).

    ``side`` is ``chosen`` or ``rejected``; the masks are arrays of (length, loss).
    """
    turn = F.struct(F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    side = lambda s: F.sort_array(F.collect_list(F.when(F.col("side") == s, turn))).alias(s)
    pairs = turns.where("pair_id IS NOT NULL AND side IN ('chosen', 'rejected')").groupBy("pair_id").agg(side("chosen"), side("rejected"))
    same = F.expr("transform(arrays_zip(chosen, rejected), x -> x.chosen.role <=> x.rejected.role AND x.chosen.text <=> x.rejected.text)")
    first = F.array_position(same, False)  # 0: no difference
    cut = (pairs.withColumn("n", F.when(first == 0, F.size("chosen")).otherwise(first - 1).cast("int"))
           .select("pair_id", "n", F.expr("slice(chosen, 1, n)").alias("p"), F.expr("slice(chosen, n + 1, size(chosen))").alias("c"),
                   F.expr("slice(rejected, n + 1, size(rejected))").alias("r")))
    return cut.select("pair_id", F.col("n").alias("n_prompt_turns"), _rendered(F.col("p")).alias("prompt"),
                      _rendered(F.col("c")).alias("chosen"), _mask(F.col("c"), trained).alias("chosen_mask"),
                      _rendered(F.col("r")).alias("rejected"), _mask(F.col("r"), trained).alias("rejected_mask"))


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs from single conversations (conv_id, turn, role, text), one for each conversation.

    Chosen is the conversation.  Rejected is the same with its last assistant reply replaced by the last
    reply of the partner conversation (ids 2n and 2n + 1 are partners; an id that is not written as an
    integer has none), or without it if the partner has none.  Turns after that reply are on both sides (no assistant's, so without loss).  A
    conversation without assistant turns is on both sides as it is.
    """
    t = (conversations.where("conv_id IS NOT NULL")
         .select(F.col("conv_id").alias("pair_id"), F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
                 F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    last = (t.where("role = 'assistant'").groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("m"))
            .select("pair_id", F.col("m.turn").alias("last"), F.col("m.text").alias("reply")))
    both = t.join(last.select("pair_id", "last"), "pair_id", "left")
    sides = both.withColumn("side", F.explode(F.when(F.col("last").isNull() | (F.col("turn") != F.col("last")), F.array(F.lit("chosen"), F.lit("rejected")))
                                              .when(F.col("turn") == F.col("last"), F.array(F.lit("chosen")))))
    kind = t.schema["pair_id"].dataType
    number = F.col("pair_id").cast("string").try_cast("bigint")
    other = (last.where(number.cast("string") == F.col("pair_id").cast("string"))
             .select(number.bitwiseXOR(F.lit(1)).cast(kind).alias("pair_id"), F.col("reply").alias("text")))
    swapped = last.join(other, "pair_id").select("pair_id", F.col("last").alias("turn"), F.lit("assistant").alias("role"), "text",
                                                 F.lit("rejected").alias("side"))
    return sides.select("pair_id", "turn", "role", "text", "side").unionByName(swapped)


#: DuckDB: the same pairs and rendering, the masks as text.
ORACLE = r"""
WITH t AS (SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT conv_id, turn AS l, text AS reply FROM (
           SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) AS k FROM t WHERE role = 'assistant') WHERE k = 1),
sides AS (
  SELECT conv_id, 'chosen' AS side, turn, role, text FROM t LEFT JOIN last USING (conv_id)
  UNION ALL SELECT conv_id, 'rejected', turn, role, text FROM t LEFT JOIN last USING (conv_id) WHERE l IS NULL OR turn <> l
  UNION ALL SELECT a.conv_id, 'rejected', a.l, 'assistant', b.reply FROM last a JOIN last b ON b.conv_id = xor(a.conv_id, 1)),
pos AS (SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn, role, text) AS p,
               '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown,
               '0:' || (length(role) + 5) || ',' || CASE WHEN role = 'assistant' THEN '1:' ELSE '0:' END || (length(text) + 8) AS mask
        FROM sides),
c AS (SELECT * FROM pos WHERE side = 'chosen'), r AS (SELECT * FROM pos WHERE side = 'rejected'),
cmp AS (SELECT conv_id, p, coalesce(c.role = r.role AND c.text = r.text, false) AS same FROM c FULL JOIN r USING (conv_id, p)),
pre AS (SELECT conv_id, coalesce(min(p) FILTER (NOT same) - 1, max(p)) AS n FROM cmp GROUP BY conv_id)
SELECT conv_id AS pair_id, any_value(n)::INTEGER AS n_prompt_turns,
       coalesce(string_agg(shown, '' ORDER BY p) FILTER (side = 'chosen' AND p <= n), '') AS prompt,
       coalesce(string_agg(shown, '' ORDER BY p) FILTER (side = 'chosen' AND p > n), '') AS chosen,
       coalesce(string_agg(mask, ',' ORDER BY p) FILTER (side = 'chosen' AND p > n), '') AS chosen_mask,
       coalesce(string_agg(shown, '' ORDER BY p) FILTER (side = 'rejected' AND p > n), '') AS rejected,
       coalesce(string_agg(mask, ',' ORDER BY p) FILTER (side = 'rejected' AND p > n), '') AS rejected_mask
FROM pos JOIN pre USING (conv_id) GROUP BY conv_id
"""
