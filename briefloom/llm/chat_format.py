"""Chat formatting in DataFrame operations only.

A conversation becomes one string: adjacent turns of one role form a block
``<|start|>role<|turn|>text<|turn|>text<|end|>``. Inside roles and texts every control string is
broken by an escape mark, reversibly, so that the marks of the template are the only ones.
The loss mask is a list of byte spans of the string: the texts of assistant turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, TURN, END = "<|start|>", "<|turn|>", "<|end|>"
# Control strings of common chat templates that must not appear inside a text.
CONTROL = (
    START, TURN, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
    "<|system|>", "<|user|>", "<|assistant|>", "<|endoftext|>",
)
ESCAPE = "\\"


def escape(text: Column) -> Column:
    """Doubles the escape mark, then puts one after the first character of every control string."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + ESCAPE + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """(conv_id, formatted, loss_spans): one row per conversation, spans as (start, length) in bytes.

    Turns go by ``turn`` (nulls first), ties by role and text. A null text or role is empty.
    Rows with a null ``conv`` form one conversation; repeated rows are turns of their own. An
    empty table gives no rows. Other columns are not read. All turns of one conversation
    meet in one task, as its single output string does.
    """
    rows = turns.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        escape(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("body"),
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    opens = F.coalesce(F.lag("role").over(in_order) != F.col("role"), F.lit(True))
    closes = F.coalesce(F.lead("role").over(in_order) != F.col("role"), F.lit(True))
    head = F.when(opens, F.concat(F.lit(START), escape(F.col("role")), F.lit(TURN))).otherwise(F.lit(TURN))
    tail = F.when(closes, F.lit(END)).otherwise(F.lit(""))
    pieces = rows.withColumns({"head": head, "tail": tail, "k": F.row_number().over(in_order)})
    size = F.octet_length("head") + F.octet_length("body") + F.octet_length("tail")
    by_place = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("at", F.sum(size).over(by_place) - F.octet_length("body") - F.octet_length("tail"))
    gathered = pieces.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("k", "head", "body", "tail", "at", (F.col("role") == loss_role).alias("loss")))).alias("p")
    )
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["body"], x["tail"])), "").alias("formatted"),
        F.transform(
            F.filter("p", lambda x: x["loss"]),
            lambda x: F.struct(x["at"].alias("start"), F.octet_length(x["body"]).cast("long").alias("length")),
        ).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, as an array of structs."""
    blocks = F.filter(F.split(formatted, _quoted(END)), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        parts = F.split(F.substr(block, F.lit(len(START) + 1)), _quoted(TURN))
        return F.transform(
            F.slice(parts, F.lit(2), F.size(parts) - 1),
            lambda t: F.struct(unescape(parts[0]).alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns_of))


def _quoted(mark: str) -> str:
    return mark.replace("|", r"\|")


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    raw = formatted.cast("binary")
    return F.array_join(
        F.transform(
            spans, lambda s: unescape(F.substr(raw, s["start"].cast("int") + 1, s["length"].cast("int")).cast("string"))
        ),
        "",
    )


PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8_chat_format(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    rows = F.array(*[F.struct(*map(F.lit, row)) for row in PLANTED])
    planted = spark.range(1).select(F.inline(rows).alias("conv_id", "turn", "role", "text"))
    chats = format_chats(conversations.select("conv_id", "turn", "role", "text").unionByName(planted))
    read = chats.withColumn("turns", read_turns(F.col("formatted"))).withColumn(
        "loss", read_loss(F.col("formatted"), F.col("loss_spans"))
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
