"""Conversations as training windows of a token budget, in DataFrame functions only.

Prefix sums of the turns' tokens cut a conversation at turns. With S = (budget - history - system
turn) / 2, turns whose first token falls into the same stretch of S tokens share a window; a turn is
at most S long there, so a window's own turns hold at most 2 S tokens. A longer turn gets a window of
its own, since turns are never cut. Every window but the first starts with the conversation's system
turn, if it has one, and with the turns of the last ``history`` tokens before it. Those repeat what
other windows teach, so the loss mask leaves them out: each assistant text is a target exactly once.

A turn is written ``### role: text</turn>`` and a line feed. Backslashes, ``##`` and ``</`` inside
texts are escaped with backslashes, so neither mark can occur there, and reading is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.blocks import quoted

BUDGET = 2048
HISTORY = 256
TARGET = "assistant"
SYSTEM = "system"
TURN_END = "</turn>\n"


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("##"), F.lit("#\\#"))
    return F.replace(text, F.lit("</"), F.lit("<\\/"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def written_role(role: Column) -> Column:
    """Plain names as they are, others in hexadecimal behind an equals sign."""
    return F.when(role.rlike("^[A-Za-z0-9_-]+$") & ~role.contains("\n"), role).otherwise(
        F.concat(F.lit("="), F.hex(F.encode(role, "utf-8")))
    )


def read_role(written: Column) -> Column:
    return F.when(written.startswith("="), F.decode(F.unhex(written.substr(F.lit(2), F.length(written))), "utf-8")).otherwise(written)


def estimated_tokens(text: Column) -> Column:
    """A token for every four characters, and two for the marks of a turn."""
    return F.ceil(F.length(text) / 4).cast("bigint") + 2


def format_windows(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    tokens=estimated_tokens,
) -> DataFrame:
    """One row per conversation and window: ``conv_id``, ``window`` (from 0), ``formatted``,
    ``loss_spans`` (start and end of the escaped target texts in code points, end exclusive),
    ``n_repeated`` (turns in front that other windows teach), ``n_tokens`` (repeated ones included).

    Null roles and texts count as empty; rows with a null id form one conversation. Turns are ordered
    by turn (null first), ties by role and text; repeated rows are repeated turns. Only the four
    named columns are read; an empty table gives no rows.
    """
    base = turns.select(
        F.col(quoted(id_col)).alias("conv_id"),
        F.col(quoted(turn_col)).alias("turn"),
        F.coalesce(F.col(quoted(role_col)).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("conv_id")
    head = F.concat(F.lit("### "), written_role(F.col("role")), F.lit(": "))
    rows = (
        base.withColumn("tokens", F.greatest(tokens(F.col("text")).cast("bigint"), F.lit(1)))
        .withColumn("head", F.length(head))
        .withColumn("marked", F.concat(head, escaped(F.col("text")), F.lit(TURN_END)))
        .withColumn("position", F.row_number().over(order))
        .withColumn("first_token", F.sum("tokens").over(upto) - F.col("tokens"))
        .withColumn("first_char", F.sum(F.length("marked").cast("bigint")).over(upto) - F.length("marked"))
        .withColumn("is_system", (F.col("position") == 1) & (F.col("role") == SYSTEM))
        .withColumn("system", F.max(F.when(F.col("is_system"), F.struct("tokens", "marked"))).over(whole))
        .withColumn(
            "stretch",
            F.greatest(F.lit(1), F.floor((F.lit(budget - history) - F.coalesce("system.tokens", F.lit(0))) / 2)),
        )
        .withColumn("long", F.col("tokens") > F.col("stretch"))
        .withColumn("place", F.struct(F.floor(F.col("first_token") / F.col("stretch")).alias("at"), F.col("long")))
        .withColumn("before", F.lag("place").over(order))
        .withColumn("cut", F.col("before").isNull() | F.col("long") | (F.col("before") != F.col("place")))
        .withColumn("window", F.sum(F.col("cut").cast("int")).over(upto) - 1)
        .withColumn(
            "history",
            F.collect_list(F.when(~F.col("is_system"), F.struct("marked", "tokens"))).over(
                Window.partitionBy("conv_id").orderBy("first_token").rangeBetween(-history, -1)
            ),
        )
    )
    turn = F.struct("position", "marked", "role", "first_char", "head", "tokens", "is_system")
    grouped = rows.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(turn)).alias("turns"),
        F.min_by(F.struct("history", "system"), "position").alias("start"),
    )
    repeat_system = F.col("start.system").isNotNull() & (F.col("window") > 0)
    system = F.when(repeat_system, F.col("start.system.marked")).otherwise("")
    front = F.concat(system, F.array_join("start.history.marked", ""))
    offset = F.length("front") - F.element_at("turns", 1)["first_char"]

    def total(turns: Column) -> Column:
        return F.aggregate(turns, F.lit(0).cast("bigint"), lambda n, t: n + t["tokens"])

    targets = F.filter("turns", lambda t: t["role"] == TARGET)
    return grouped.withColumn("front", front).select(
        "conv_id",
        "window",
        F.concat("front", F.array_join("turns.marked", "")).alias("formatted"),
        F.transform(
            targets,
            lambda t: F.struct(
                (offset + t["first_char"] + t["head"]).alias("start"),
                (offset + t["first_char"] + F.length(t["marked"]) - len(TURN_END)).alias("end"),
            ),
        ).alias("loss_spans"),
        (F.size("start.history") + repeat_system.cast("int")).alias("n_repeated"),
        (
            total(F.col("turns")) + total(F.col("start.history")) + F.when(repeat_system, F.col("start.system.tokens")).otherwise(0)
        ).alias("n_tokens"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows: ``turns`` (role and text), ``loss``
    (target texts in order) and ``formatted_chars``."""
    parts = F.filter(F.split("formatted", TURN_END, -1), lambda p: p != "")
    own = F.slice(parts, F.col("n_repeated") + 1, F.size(parts))

    def turn(part: Column) -> Column:
        colon = F.instr(part, ": ")
        role = part.substr(F.lit(5), colon - 5)
        return F.struct(read_role(role).alias("role"), unescaped(part.substr(colon + 2, F.length(part))).alias("text"))

    def target(span: Column) -> Column:
        return unescaped(F.col("formatted").substr((span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int")))

    read = windows.select(
        "conv_id",
        F.struct(
            "window",
            F.transform(own, turn).alias("turns"),
            F.transform("loss_spans", target).alias("loss"),
            F.length("formatted").cast("bigint").alias("chars"),
        ).alias("read"),
    )
    return (
        read.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("read")).alias("reads"))
        .select(
            "conv_id",
            F.flatten("reads.turns").alias("turns"),
            F.flatten("reads.loss").alias("loss"),
            F.aggregate("reads.chars", F.lit(0).cast("bigint"), lambda n, c: n + c).alias("formatted_chars"),
        )
    )
