r"""Chat formatting in budgeted windows.

Every turn becomes ``<s>[role]text</s>``. Inside roles and texts the characters that can start a
mark are replaced (backslash ``\b``, ``<`` ``\l``, ``[`` ``\s``, and ``]`` ``\e`` in roles), so no
text can imitate a mark and the original is restored exactly.

Turns are cut into windows by prefix sums of their token counts, at turn boundaries only: a turn
belongs to the window in whose stretch of ``stride`` tokens it ends, and a turn of over ``stride``
tokens stands alone. With ``stride`` half of what the budget leaves after the system turn and the
history, own turns fit the budget, except a single turn that is longer than the budget itself. A
later window starts with the system turn and the last turns before it, as far as the history
budget reaches. Only texts of the target role in a window's own turns carry loss, so every target
counts once.

A long conversation is spread over tasks: prefix sums are taken in blocks of turn numbers with the
blocks' totals added, and the history is looked up in blocks of the prefix sum. No window, and
nothing but the digest of a conversation, holds a whole conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

TURNS_A_BLOCK = 1024
TOKENS_A_BLOCK = 1 << 16
TURN_OVERHEAD = 4


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\s"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("[")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("]"), F.lit("\\e"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\e"), F.lit("]")))


def estimated_tokens(text: Column) -> Column:
    """One token per four characters and the marks of a turn; needs no vocabulary."""
    return F.ceil(F.length(text) / 4) + TURN_OVERHEAD


def _prefix_sums(turns: DataFrame) -> DataFrame:
    """Adds ``before`` and ``through``, the token sums without and with the turn, in its conversation."""
    turns = turns.withColumn("_block", F.floor(F.col("turn") / TURNS_A_BLOCK))
    totals = turns.groupBy("conv_id", "_block").agg(F.sum("tokens").alias("_sum"))
    earlier = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("conv_id").alias("_conv"), F.col("_block").alias("_b"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base")
    )
    joined = turns.join(totals, turns["conv_id"].eqNullSafe(totals["_conv"]) & turns["_block"].eqNullSafe(totals["_b"]))
    order = Window.partitionBy("conv_id", "_block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    through = (F.col("_base") + F.sum("tokens").over(order)).alias("through")
    return joined.select("conv_id", "turn", "role", "text", "tokens", through).withColumn("before", F.col("through") - F.col("tokens"))


def windows(
    conversations: DataFrame,
    budget: int = 1024,
    history: int = 128,
    min_stride: int = 64,
    target: str = "assistant",
    tokens: Column | None = None,
) -> DataFrame:
    """One row per window: conv_id, window, n_context (leading repeated turns), formatted, loss.

    ``loss`` is an array of (start from 1, length) in code points of ``formatted``. Null roles and
    texts count as empty, null turns come first, repeated rows stay, ties go by role and text; other
    columns are not read. ``tokens``: expression over role and text; by default ``estimated_tokens``, an
    estimate by characters, not the count of a model's tokenizer.
    """
    turns = conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("turn", F.coalesce("turn", F.lit(-(1 << 62))))
    turns = turns.withColumn("tokens", estimated_tokens(F.col("text")) if tokens is None else tokens)
    # Several parts of the plan start here: without the files each would shuffle the texts for the sums again.
    turns = stage(_prefix_sums(turns), "chat-turns")

    leading = (F.col("role") == "system") & (F.col("before") == 0)
    system = turns.where(leading).select(
        F.col("conv_id").alias("_conv"), F.col("tokens").alias("_sys_tokens"), F.col("text").alias("_sys_text"))
    turns = turns.join(system, turns["conv_id"].eqNullSafe(system["_conv"]), "left").drop("_conv")
    room = F.lit(budget - history) - F.coalesce("_sys_tokens", F.lit(0))
    stride = F.greatest(F.lit(min_stride), F.floor(room / 2))
    turns = turns.withColumn("_long", F.col("tokens") > stride).withColumn("_cell", F.floor((F.col("through") - 1) / stride))

    # A window is a run of turns with one cell, broken at long turns; it is named by the prefix sum at its start.
    turns = turns.withColumn("_bucket", F.floor(F.col("before") / TOKENS_A_BLOCK))
    edge = turns.where(F.col("_long") | (F.col("before") == 0)).select("conv_id", "_cell", "before", "through", "_long")
    edges = edge.groupBy("conv_id", "_cell").agg(
        F.sort_array(F.collect_list(F.when(F.col("_long"), F.col("before")))).alias("_cuts"))
    edges = edges.select(F.col("conv_id").alias("_conv"), F.col("_cell").alias("_c"), "_cuts")
    turns = turns.join(edges, turns["conv_id"].eqNullSafe(edges["_conv"]) & (turns["_cell"] == edges["_c"]), "left").drop("_conv", "_c")
    part = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<bigint>")), lambda c: c < F.col("before")))
    turns = turns.withColumn("_part", part * 2 + F.col("_long").cast("int"))

    # First turns of windows, looked up by the turns before them.
    first = turns.groupBy("conv_id", "_cell", "_part").agg(F.min("before").alias("start"))
    starts = first.withColumn("_bucket", F.explode(F.sequence(
        F.floor(F.greatest(F.col("start") - history, F.lit(0)) / TOKENS_A_BLOCK), F.floor(F.col("start") / TOKENS_A_BLOCK))))
    rows = turns.select(
        "conv_id", "_bucket", "_cell", "_part", "role", "text", "before", "turn", "_sys_text", F.lit(None).cast("bigint").alias("start")
    ).unionByName(starts.where("start > 0").select("conv_id", "_bucket", "_cell", "_part", "start"), allowMissingColumns=True)
    ahead = Window.partitionBy("conv_id", "_bucket").orderBy(F.coalesce("start", "before")).rangeBetween(1, history)
    later = F.collect_list(F.when(F.col("start").isNotNull(), F.struct("start", "_cell", "_part"))).over(ahead)
    rows = rows.withColumn("_later", later).where("start is null")

    own = F.array(F.struct(F.lit(2).alias("kind"), "_cell", "_part"))
    # A window in the same cell and part is the turn's own.
    past = F.transform("_later", lambda w: F.struct(F.lit(1).alias("kind"), w["_cell"], w["_part"]))
    rows = rows.withColumn("_to", F.explode(F.concat(own, past)))
    mark = F.concat(F.lit("<s>["), escape_role(F.col("role")), F.lit("]"))
    pieces = rows.select(
        "conv_id", F.col("_to._cell").alias("_cell"), F.col("_to._part").alias("_part"), F.col("_to.kind").alias("kind"), "before", "turn",
        "_sys_text", mark.alias("mark"), escape(F.col("text")).alias("body"),
        ((F.col("_to.kind") == 2) & (F.col("role") == target)).alias("loss"))
    grouped = pieces.groupBy("conv_id", "_cell", "_part").agg(
        F.max("_sys_text").alias("_sys_text"), F.min("before").alias("_from"), F.min(F.when(F.col("kind") == 2, F.col("before"))).alias("start"),
        F.sort_array(F.collect_list(F.struct("before", "kind", "mark", "body", "loss"))).alias("turns"))
    # The system turn leads every window that does not reach back to it.
    system_turn = F.struct(F.lit(-1).cast("bigint").alias("before"), F.lit(0).alias("kind"), F.lit("<s>[system]").alias("mark"),
                           escape(F.col("_sys_text")).alias("body"), F.lit(False).alias("loss"))
    grouped = grouped.withColumn("turns", F.when(
        F.col("_sys_text").isNotNull() & (F.col("_from") > 0), F.concat(F.array(system_turn), F.col("turns"))).otherwise(F.col("turns")))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["mark"], t["body"], F.lit("</s>"))), "")
    empty = F.struct(F.lit(1).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(t["mark"])
        span = F.struct(start.cast("bigint").alias("start"), F.length(t["body"]).cast("bigint").alias("length"))
        return F.struct((start + F.length(t["body"]) + 4).cast("bigint").alias("at"),
                        F.when(t["loss"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return grouped.select(
        "conv_id", F.col("start").alias("window"),
        F.size(F.filter("turns", lambda t: t["kind"] < 2)).alias("n_context"),
        formatted.alias("formatted"), F.aggregate("turns", empty, step, lambda a: a["spans"]).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: turns (role, text, in order) and loss_texts."""
    marks = F.filter(F.split("formatted", "</s>"), lambda p: p != "")
    own = F.slice(marks, F.col("n_context") + 1, F.size(marks))
    turns = F.transform(own, lambda p: F.struct(
        unescape_role(F.regexp_extract(p, r"^<s>\[([^\]]*)\]", 1)).alias("role"),
        unescape(F.regexp_replace(p, r"^<s>\[[^\]]*\]", "")).alias("text")))
    loss = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"].cast("int"), s["length"].cast("int"))))
    per_window = formatted.select("conv_id", "window", turns.alias("turns"), loss.alias("loss"), F.length("formatted").alias("chars"))
    return per_window.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("_windows"), F.sum("chars").alias("formatted_chars")
    ).select("conv_id", F.flatten(F.col("_windows.turns")).alias("turns"), F.flatten(F.col("_windows.loss")).alias("loss_texts"), "formatted_chars")
