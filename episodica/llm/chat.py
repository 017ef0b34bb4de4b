"""Chat formatting with Spark expressions only.

A conversation's rows are gathered as structs, sorted by turn (ties by role,
then text), and written as one string. Adjacent turns of one role share a block:

    <|turn|>role\\ntext<|part|>text<|end|>

Inside texts every backslash is doubled and a backslash is put into each control
string, this template's and those of other common ones; `unescape` undoes it, so
the formatted string can be read back to the very rows.

The loss mask is a list of places in the formatted string, in bytes of UTF-8, one
for each text of the loss role; `read_loss` cuts them out and unescapes them.

A conversation has to become one string, so its own rows do meet in one task, and
texts of any length are kept whole; nothing else meets. Null texts and roles count
as empty, null turns sort first, null conversation ids form one conversation,
repeated rows stay, an empty table gives no rows. Other columns of the input,
whatever their names, are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ends

TURN, PART, END = "<|turn|>", "<|part|>", "<|end|>"
#: Where a backslash goes: doubling one, or inside <|, </s>, <s>, [INST] and [/INST].
ESCAPED = r"(\\)|(?<=<)(?=\||/s>|s>)|(?<=\[)(?=/?INST\])"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, ESCAPED, r"\\$1")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def escape_role(c: Column) -> Column:
    for plain, coded in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape_role(c: Column) -> Column:
    for coded, plain in (("%3C", "<"), ("%0A", "\n"), ("%25", "%")):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def format_conversations(df: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted and loss: array of struct(start, end), the bytes of formatted under the loss mask."""
    rows = df.select(
        "conv_id",
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("row"),
    )
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("turns"))

    def pieces(x: Column, i: Column) -> Column:
        starts = (i == 0) | (F.get("turns", i - 1)["role"] != x["role"])
        last = (i == F.size("turns") - 1) | (F.get("turns", i + 1)["role"] != x["role"])
        piece = lambda c, loss: F.struct(c.alias("text"), loss.alias("loss"))
        return F.array(
            piece(F.when(starts, F.concat(F.lit(TURN), escape_role(x["role"]), F.lit("\n"))).otherwise(F.lit(PART)), F.lit(False)),
            piece(escape(x["text"]), x["role"] == loss_role),
            piece(F.when(last, F.lit(END)).otherwise(F.lit("")), F.lit(False)),
        )

    segments = turns.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("segments"))
    segments = segments.withColumn("sizes", F.transform("segments", lambda s: F.octet_length(s["text"]).cast("long")))
    segments = segments.withColumn("ends", F.expr(ends("sizes")))
    mask = "filter(transform(segments, (s, i) -> if(s.loss, struct(cast(ends[i] - sizes[i] as int) as start, cast(ends[i] as int) as end), null)), x -> x is not null)"
    return segments.select("conv_id", F.array_join("segments.text", "").alias("formatted"), F.expr(mask).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The rows that a formatted string holds, as an array of (role, text)."""
    blocks = F.slice(F.split(formatted, r"<\|end\|>"), 1, F.size(F.split(formatted, r"<\|end\|>")) - 1)

    def rows(block: Column) -> Column:
        cut = F.instr(block, "\n")
        role = unescape_role(F.substring(block, F.lit(len(TURN) + 1), cut - len(TURN) - 1))
        parts = F.split(F.substring(block, cut + 1, F.char_length(block)), r"<\|part\|>")
        return F.transform(parts, lambda p: F.struct(role.alias("role"), unescape(p).alias("text")))

    return F.flatten(F.transform(blocks, rows))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    coded = F.encode(formatted, "UTF-8")
    return F.array_join(F.transform(loss, lambda x: unescape(F.decode(F.substring(coded, x["start"] + 1, x["end"] - x["start"]), "UTF-8"))), "")
