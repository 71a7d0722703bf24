"""Preference pairs: one prompt, and a chosen and a rejected completion with the spans that a loss may see.

Both sides of a pair are conversations. Their longest common prefix of turns (same role, same text) is rendered once as
the prompt; what follows on each side is its completion. In a completion only the text of `assistant` turns and the mark
that ends it are trained on; headers and other roles are masked out. Spans are code points of the completion.

A turn is rendered as `<|im_start|>role`, a line break, its text, `<|im_end|>`, a line break. A mark in a text is taken
apart by a space, so that no text can end its turn.

Turns are numbered in order of turn, role, text, and compared number by number: the prefix ends before the first number
at which the sides differ, found by an aggregate over joined turns, so no side is gathered for it. Rendering gathers the
turns of one conversation, which is one output row.

Defined results: null role or text is empty; a null turn comes first; turns with equal numbers are ordered by role and
text, and repeated rows are turns of their own; rows without pair id belong to no pair and are left out; a pair that
lacks a side is left out; if one side is a prefix of the other its completion is empty; other columns are ignored; empty
tables give an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, TRAINED = "<|im_start|>", "<|im_end|>", "assistant"
SIDES = ("chosen", "rejected")


def turns(side: DataFrame, pair_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(pair, pos, role, text): numbered turns."""
    rows = side.where(F.col(pair_col).isNotNull()).select(
        F.col(pair_col).alias("pair"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    place = Window.partitionBy("pair").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select("pair", F.row_number().over(place).alias("pos"), "role", "text")


def _safe(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), _safe(role), F.lit("\n"), _safe(text), F.lit(CLOSE + "\n"))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, pair_col: str = "pair_id", turn_col: str = "turn",
                     role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per pair: `pair_col`, `n_prompt_turns`, `prompt`, and for each side `*_completion` and `*_trained`, an array of
    (start, end) in it."""
    both = turns(chosen, pair_col, turn_col, role_col, text_col).withColumn("side", F.lit(0)).unionByName(
        turns(rejected, pair_col, turn_col, role_col, text_col).withColumn("side", F.lit(1)))
    # a number at which not both sides have the same turn ends the prefix
    numbers = both.groupBy("pair", "pos").agg(
        (F.min("side") != F.max("side")).alias("on_both"),
        (F.min(F.struct("role", "text")) == F.max(F.struct("role", "text"))).alias("same"))
    ends = numbers.groupBy("pair").agg(
        F.least(F.min(F.when(~(F.col("on_both") & F.col("same")), F.col("pos"))), F.max("pos") + 1).alias("end"))
    marked = both.join(ends, "pair").select(
        "pair", "side", "pos", (F.col("pos") < F.col("end")).alias("shared"), F.length(_safe(F.col("role"))).alias("role_size"),
        (F.col("role") == TRAINED).alias("trained"), rendered(F.col("role"), F.col("text")).alias("turn"))
    parts = marked.groupBy("pair").agg(
        (F.min("side") != F.max("side")).alias("whole"),
        F.count_if(F.col("shared") & (F.col("side") == 0)).alias("n_prompt_turns"),
        F.array_sort(F.collect_list(F.when(F.col("shared") & (F.col("side") == 0), F.struct("pos", "turn")))).alias("prompt"),
        *[F.array_sort(F.collect_list(F.when(~F.col("shared") & (F.col("side") == k),
                                             F.struct("pos", "turn", "role_size", "trained")))).alias(name)
          for k, name in enumerate(SIDES)])

    def completion(name: str) -> Column:
        return F.array_join(F.transform(name, lambda t: t["turn"]), "")

    def spans(name: str) -> Column:
        """Running positions; a trained turn gives its text and the closing mark, without header and line break."""
        empty = F.array().cast("array<struct<start:long,end:long>>")
        start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))

        def step(state: Column, t: Column) -> Column:
            end = state["at"] + F.length(t["turn"])
            span = F.struct((state["at"] + len(OPEN) + t["role_size"] + 1).cast("long").alias("start"), (end - 1).alias("end"))
            return F.struct(end.alias("at"), F.when(t["trained"], F.concat(state["spans"], F.array(span))).otherwise(
                state["spans"]).alias("spans"))

        return F.aggregate(F.col(name), start, step, lambda s: s["spans"])

    return parts.where("whole").select(
        F.col("pair").alias(pair_col), "n_prompt_turns", F.array_join(F.transform("prompt", lambda t: t["turn"]), "").alias("prompt"),
        *[c for name in SIDES for c in (completion(name).alias(f"{name}_completion"), spans(name).alias(f"{name}_trained"))])


def swapped_endings(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides from plain conversations: the chosen side is a conversation up to its last assistant
    turn; the rejected side ends with the last assistant turn of its neighbour (ids 2k and 2k + 1) instead."""
    spoken = conversations.where(F.col(id_col).isNotNull() & F.col(turn_col).isNotNull())
    last = spoken.where(F.col(role_col) == TRAINED).groupBy(F.col(id_col).alias("pair_id")).agg(
        F.max(F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))).alias("last"))
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("last.text").alias("ending"))
    ends = last.join(other, "pair_id").select("pair_id", F.col("last.turn").alias("last_turn"), F.col("last.text").alias("own"), "ending")
    before = spoken.select(F.col(id_col).alias("pair_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                           F.col(text_col).alias("text")).join(ends, "pair_id").where("turn < last_turn").select("pair_id", "turn", "role", "text")

    def ending(column: str) -> DataFrame:
        return ends.select("pair_id", F.col("last_turn").alias("turn"), F.lit(TRAINED).alias("role"), F.col(column).alias("text"))

    return before.unionByName(ending("own")), before.unionByName(ending("ending"))


_SIDE_SQL = """
SELECT pair_id, row_number() OVER (PARTITION BY pair_id ORDER BY turn, role, text) AS pos, role,
       replace(replace(text, '<|', '< |'), '|>', '| >') AS text FROM ({})"""
PAIRS_SQL = f"""
WITH spoken AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
l AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) AS r
      FROM spoken WHERE role = '{TRAINED}'),
ends AS (SELECT a.conv_id AS pair_id, a.turn AS last_turn, a.text AS own, b.text AS ending
         FROM l a JOIN l b ON a.r = 1 AND b.r = 1 AND b.conv_id = xor(a.conv_id, 1)),
prior AS (SELECT pair_id, turn, role, text FROM spoken JOIN ends ON conv_id = pair_id WHERE turn < last_turn),
c AS ({_SIDE_SQL.format(f"SELECT * FROM prior UNION ALL SELECT pair_id, last_turn, '{TRAINED}', own FROM ends")}),
r AS ({_SIDE_SQL.format(f"SELECT * FROM prior UNION ALL SELECT pair_id, last_turn, '{TRAINED}', ending FROM ends")}),
diff AS (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id,
                min(coalesce(c.pos, r.pos)) FILTER (c.pos IS NULL OR r.pos IS NULL OR c.role <> r.role OR c.text <> r.text) AS first,
                max(coalesce(c.pos, r.pos)) + 1 AS past
         FROM c FULL JOIN r ON c.pair_id = r.pair_id AND c.pos = r.pos GROUP BY 1),
cut AS (SELECT pair_id, coalesce(first, past) AS stop FROM diff),
shown AS (
  SELECT 'chosen' AS side, pair_id, pos, role, '{OPEN}' || role || chr(10) || text || '{CLOSE}' || chr(10) AS turn, pos < stop AS shared
  FROM c JOIN cut USING (pair_id)
  UNION ALL SELECT 'rejected', pair_id, pos, role, '{OPEN}' || role || chr(10) || text || '{CLOSE}' || chr(10), pos < stop
  FROM r JOIN cut USING (pair_id)),
placed AS (SELECT *, coalesce(sum(length(turn)) FILTER (NOT shared) OVER (PARTITION BY side, pair_id ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM shown)
SELECT pair_id, count(*) FILTER (side = 'chosen' AND shared) AS n_prompt_turns,
       coalesce(string_agg(turn, '' ORDER BY pos) FILTER (side = 'chosen' AND shared), '') AS prompt,
       coalesce(string_agg(turn, '' ORDER BY pos) FILTER (side = 'chosen' AND NOT shared), '') AS chosen_completion,
       coalesce(string_agg(concat(CAST(start + {len(OPEN) + 1} + length(role) AS BIGINT), ':', CAST(start + length(turn) - 1 AS BIGINT)), ',' ORDER BY pos)
                FILTER (side = 'chosen' AND NOT shared AND role = '{TRAINED}'), '') AS chosen_trained,
       coalesce(string_agg(turn, '' ORDER BY pos) FILTER (side = 'rejected' AND NOT shared), '') AS rejected_completion,
       coalesce(string_agg(concat(CAST(start + {len(OPEN) + 1} + length(role) AS BIGINT), ':', CAST(start + length(turn) - 1 AS BIGINT)), ',' ORDER BY pos)
                FILTER (side = 'rejected' AND NOT shared AND role = '{TRAINED}'), '') AS rejected_trained
FROM placed GROUP BY pair_id
"""
