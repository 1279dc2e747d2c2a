"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context and only its text
trainable. Turns after the last assistant turn make a last example with nothing trainable, so that the
examples hold the whole conversation. A turn reads ``<|im_start|>role\\ntext<|im_end|>\\n``; the role is
percent-encoded. In texts a backslash is doubled and a control string gets one backslash after its first
character, which can be undone exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that must not occur in a formatted text but as marks of the template or of another one.
CONTROL = (START, END, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    out = text
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark[0] + "\\" + mark[1:]), F.lit(mark))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def examples(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``id, target, whole, formatted, loss_start, loss_chars`` per example.

    ``target`` is the number (from 0) of the trainable turn in its conversation, or that of the last turn
    where nothing is trainable; the trainable text is ``loss_chars`` code points of ``formatted`` from
    ``loss_start`` (from 0) on; ``loss_chars`` is NULL where there is none. ``whole`` marks the one example of
    a conversation that holds all its turns. Turns are sorted by number,
    then role and text; repeated turns all stay. NULL texts and roles are empty, NULL ids one
    conversation. A conversation is put together in one row, since each example needs its whole prefix;
    examples are made one at a time and not gathered.
    """
    role = F.coalesce(turns[role_col].cast("string"), F.lit(""))
    text = F.coalesce(turns[text_col].cast("string"), F.lit(""))
    rows = turns.select(turns[id_col].alias("id"), turns[turn_col].alias("turn"), role.alias("role"), text.alias("text"))
    shaped = rows.select("id", F.struct("turn", "role", "text").alias("key"), (F.col("role") == ASSISTANT).alias("answers"),
                         F.concat(F.lit(START), F.url_encode("role"), F.lit("\n")).alias("head"), escape(F.col("text")).alias("body"))
    own = shaped.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("key", "answers", "head", "body"))).alias("turns"))
    own = own.select("id", F.transform("turns", lambda t: t["answers"]).alias("answers"), F.transform("turns", lambda t: F.length(t["body"])).alias("chars"),
                     F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))).alias("pieces"))
    last = F.size("pieces") - 1
    targets = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("answers", i) | (i == last))
    each = own.select("id", "answers", "chars", "pieces", F.explode(targets).alias("target"))
    formatted = F.array_join(F.slice("pieces", F.lit(1), F.col("target") + 1), "")
    made = each.select("id", "target", (F.col("target") == last).alias("whole"), formatted.alias("formatted"), F.get("answers", F.col("target")).alias("trains"), F.get("chars", F.col("target")).alias("chars"))
    return made.select("id", "target", "whole", "formatted", F.when(F.col("trains"), F.length("formatted") - len(END) - 1 - F.col("chars")).alias("loss_start"),
                       F.when(F.col("trains"), F.col("chars")).alias("loss_chars"))


def target_text(formatted: Column, loss_start: Column, loss_chars: Column) -> Column:
    """The trainable text of an example, read back."""
    return unescape(F.substring(formatted, loss_start + 1, loss_chars))


def read_turns(formatted: Column) -> Column:
    """``role, text`` of the turns of a formatted text."""
    def turn(piece: Column) -> Column:
        at = F.instr(piece, F.lit("\n"))
        return F.struct(F.url_decode(F.substring(piece, F.lit(1), at - 1)).alias("role"),
                        unescape(F.substring(piece, at + 1, F.length(piece) - at - len(END) - 1)).alias("text"))
    quoted = START.replace("|", "\\|")
    return F.transform(F.filter(F.split(formatted, quoted), lambda p: p != ""), turn)
