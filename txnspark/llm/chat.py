"""Chat formatting: snapshots of a growing conversation collapse into the longest, which is rendered.

A conversation logged after every turn appears as several conversations, each a prefix of the next. Every turn prefix gets
a hash that rolls over the turns: the exclusive-or of the hashes of (position, role, text), so chunks of one conversation
are hashed apart and then joined, and a conversation with a third of all turns spreads over many tasks. A conversation
whose full hash equals a strict prefix of another leaves by an anti-join; of equal conversations the smallest id stays.

Defined results: rows without conv_id belong to no conversation and are left out; a NULL turn sorts after the others; a
NULL role or text differs from an empty one and is rendered empty; equal turn numbers are ordered by role, then text;
exact repeats of a row count once; a table without rows gives none. Other columns are not used. Two 64-bit hashes
with different seeds make 128 bits, so equal hashes are taken for equal turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnspark.llm.common import stored

CHUNK = 256  # turn numbers per chunk, the unit that one task hashes or renders


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns with their chunk; conversations without an id are none."""
    turn = F.col("turn").cast("bigint")
    return conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.coalesce(F.floor(turn / CHUNK), F.lit(2**53)).cast("bigint").alias("chunk"),
        turn.alias("turn"),
        "role",
        "text",
    )


def _rank() -> list[Column]:
    return [F.col("turn").asc_nulls_last(), F.col("role"), F.col("t1"), F.col("t2")]


def prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, k, h1, h2): hash of the first k turns, for every k."""
    text = F.col("text")
    turns = _turns(conversations).select(
        "conv_id", "chunk", "turn", "role",
        F.xxhash64(text.isNull(), text).alias("t1"), F.xxhash64(F.lit("second"), text.isNull(), text).alias("t2"),
    ).groupBy("conv_id", "chunk", "turn", "role", "t1", "t2").agg(F.lit(1).alias("one"))  # exact repeats once
    in_chunk = Window.partitionBy("conv_id", "chunk").orderBy(*_rank())
    placed = stored(turns.select("*", F.row_number().over(in_chunk).cast("bigint").alias("i")), "turns")
    # Positions of a chunk follow those of all earlier chunks: one row per chunk.
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("conv_id", "chunk").agg(F.max("i").alias("size"))
    offsets = sizes.select("conv_id", "chunk", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    position = F.col("offset") + F.col("i")
    turn_hash = [F.xxhash64(F.lit(s), position, F.col("role").isNull(), F.col("role"), "t1", "t2") for s in (1, 2)]
    hashed = placed.join(offsets, ["conv_id", "chunk"]).select(
        "conv_id", "chunk", position.alias("k"), turn_hash[0].alias("x1"), turn_hash[1].alias("x2")
    )
    upto = Window.partitionBy("conv_id", "chunk").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rolled = stored(
        hashed.select("conv_id", "chunk", "k", F.expr("x1").alias("x1"), "x2", *[
            F.expr(f"bit_xor({x})").over(upto).alias(h) for x, h in (("x1", "h1"), ("x2", "h2"))
        ]).drop("x1", "x2"),
        "chunk-hashes",
    )
    whole = rolled.groupBy("conv_id", "chunk").agg(F.max_by("h1", "k").alias("h1"), F.max_by("h2", "k").alias("h2"))
    before = whole.select(
        "conv_id", "chunk", *[F.coalesce(F.expr(f"bit_xor({h})").over(earlier), F.lit(0)).alias(f"{h}_before") for h in ("h1", "h2")]
    )
    return rolled.join(before, ["conv_id", "chunk"]).select(
        "conv_id", "k",
        F.col("h1").bitwiseXOR(F.col("h1_before")).alias("h1"), F.col("h2").bitwiseXOR(F.col("h2_before")).alias("h2"),
    )


def maximal(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that no other one continues; of equal ones the smallest id."""
    rolled = stored(prefixes(conversations), "turn-prefixes")
    lengths = rolled.groupBy("conv_id").agg(F.max("k").alias("n_turns"))
    full = rolled.join(lengths, "conv_id")
    key = ["k", "h1", "h2"]
    whole = full.where(F.col("k") == F.col("n_turns")).groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies")
    )
    strict = full.where(F.col("k") < F.col("n_turns")).select(*key).distinct()
    return whole.join(strict, key, "left_anti").select("conv_id", F.col("k").alias("n_turns"), "n_copies")


def _escaped(column: str) -> Column:
    """A role or text in which no control token can stand: ``<|`` and ``|>`` get a backslash between their signs."""
    text = F.coalesce(column, F.lit(""))
    return F.replace(F.replace(text, F.lit("<|"), F.lit("<\\|")), F.lit("|>"), F.lit("|\\>"))


def render(conversations: DataFrame) -> DataFrame:
    """Maximal conversations as text, one row per conversation and chunk of turns (``part``): conv_id, part, n_turns
    (of the conversation), n_copies, rendered."""
    turns = _turns(conversations)
    kept = maximal(conversations)
    chunks = stored(
        turns.select("conv_id", "chunk").distinct().join(kept, "conv_id"), "kept-chunks"
    )
    line = F.concat(F.lit("<|"), _escaped("role"), F.lit("|>\n"), _escaped("text"), F.lit("<|end|>\n"))
    parts = turns.join(chunks, ["conv_id", "chunk"]).groupBy("conv_id", "chunk").agg(
        F.array_sort(F.collect_set(F.struct(F.coalesce("turn", F.lit(2**62)).alias("turn"), "role", "text", line.alias("line")))).alias("turns"),
        F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"),
    )
    return parts.select(
        "conv_id",
        F.col("chunk").alias("part"),
        "n_turns",
        "n_copies",
        F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("rendered"),
    )
