"""Perspective rotation of dialogues: every participant in turn speaks as the assistant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: Turn numbers counted together where a dialogue is cut into parts.
TURNS = 256

HEAD, END = "<|start|>", "<|end|>\n"


def numbered(m: DataFrame, messages: int, turns: int) -> DataFrame:
    """The messages with ``part``: the place in the dialogue divided by ``messages``.

    Places are counts of smaller cells: ranges of turn numbers, turns, and hash ranges
    of a turn with many messages. A cell is whole in the part of its first message.
    """
    block = F.floor(F.col("turn") / turns)
    per_turn = m.groupBy("conv_id", "turn").agg(F.count("*").alias("n_turn"))
    crowded = m.groupBy("conv_id").agg(F.count("*").alias("n")).filter(F.col("n") > messages).select(F.col("conv_id").alias("c"))
    fine = per_turn.join(crowded, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "c", F.col("turn").alias("t"), F.ceil(F.col("n_turn") / max(messages // 2, 1)).alias("cuts"))
    m = m.join(fine, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")), "left").drop("c", "t")
    # a hash range keeps the order of ties: cut k of a turn holds hashes below those of cut k + 1
    share = F.col("tie").cast("double") / F.lit(2.0**64) + 0.5
    m = m.withColumn("cut", F.least(F.floor(share * F.col("cuts")), F.col("cuts") - 1))
    cells = m.filter("cut is not null").groupBy("conv_id", "turn", "cut").agg(F.count("*").alias("n")).withColumn("block", block)
    earlier = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_last())
    blocks = cells.groupBy("conv_id", "block").agg(F.sum("n").alias("n_block")).select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), (F.sum("n_block").over(earlier) - F.col("n_block")).alias("ahead"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_last(), "cut")
    cells = cells.withColumn("before", F.sum("n").over(inside) - F.col("n"))
    cells = cells.join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))).select(
        "c", F.col("turn").alias("t"), F.col("cut").alias("k"), F.floor((F.col("ahead") + F.col("before")) / messages).alias("at"))
    m = m.join(cells, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("cut") == F.col("k")), "left")
    return m.select("conv_id", "turn", "who", "said", "tie", F.coalesce("at", F.lit(0)).alias("part"))


def perspectives(df: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
                 system: str = "system", messages: int | None = None, turns: int = TURNS) -> DataFrame:
    """One row per dialogue and participant: the text that trains this participant, and its loss spans.

    A message renders as header, text and end mark. The chosen speaker's header is
    ``assistant``; everybody else is a user with a name; system messages stand as
    they are in every view and are nobody's view. ``spans`` are the character ranges
    [start, end) of the chosen speaker's text with its end mark.

    Messages are ordered by turn, ties by a hash of speaker and text. A dialogue is
    one row per participant whatever its length. With ``messages``, one of more
    messages is cut into parts of about as many by place in the dialogue, a row and
    spans for each, so that no task collects it; ``part`` orders them and each begins
    where the one before ends. Defined cases: a null turn comes after all others, a null
    speaker is ``unknown``, a null text is empty, equal rows are one message, rows
    with a null dialogue form one dialogue, a dialogue of system messages only gives
    no row, an empty table none.
    """
    m = df.select(F.col(conv).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                  F.coalesce(F.col(speaker), F.lit("unknown")).alias("who"),
                  F.coalesce(F.col(text), F.lit("")).alias("said")).distinct()
    people = m.filter(F.col("who") != system).select(F.col("conv_id").alias("c"), F.col("who").alias("speaker")).distinct()
    m = m.withColumn("tie", F.xxhash64("who", "said"))
    m = m.withColumn("part", F.lit(0).cast("bigint")) if messages is None else numbered(m, messages, turns)

    def head(who):
        return F.when(who == system, F.lit(f"{HEAD}{system}\n")).otherwise(F.concat(F.lit(f"{HEAD}user name="), who, F.lit("\n")))

    # where a message begins while all are users; each earlier one of the speaker's own moves it by the same number
    keys = ["conv_id"] if messages is None else ["conv_id", "part"]
    size = F.length(head(F.col("who"))) + F.length("said") + len(END)
    order = Window.partitionBy(*keys).orderBy(F.col("turn").asc_nulls_last(), "tie", "who", "said").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    m = m.withColumn("begin", F.sum(size).over(order) - size)
    parts = m.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("begin", "who", "said"))).alias("messages"))
    views = parts.join(people, F.col("conv_id").eqNullSafe(F.col("c")))
    own = f"{HEAD}assistant\n"
    rendered = F.transform("messages", lambda x: F.concat(
        F.when(x["who"] == F.col("speaker"), F.lit(own)).otherwise(head(x["who"])), x["said"], F.lit(END)))
    shift = F.length(head(F.col("speaker"))) - len(own)

    def span(x, i):
        start = x["begin"] - i * shift + len(own)
        return F.struct(start.alias("start"), (start + F.length(x["said"]) + len(END)).alias("end"))

    mine = F.filter("messages", lambda x: x["who"] == F.col("speaker"))
    part = F.lit(0).cast("bigint").alias("part") if messages is None else F.col("part")
    return views.select("conv_id", "speaker", part, F.size("messages").cast("bigint").alias("n_messages"),
                        F.array_join(rendered, "").alias("text"), F.transform(mine, span).alias("spans"))
