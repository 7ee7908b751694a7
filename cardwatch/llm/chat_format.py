"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation's rows are rendered by turn, each as

    <|im_start|>ROLE⏎TEXT<|im_end|>⏎

and the rendering is read again by a deterministic parser: cut at
``<|im_start|>``, the role up to the first line end, the text up to the closing
marker, escapes undone.  The grammar's TEXT has none of the control strings.  A
turn is rendered plainly first.  If the parser does not give back the same role
and text, or the text holds a control string, its content conflicts and is
escaped: ``\\`` becomes ``\\b``, ``<`` ``\\l`` and ``[`` ``\\s`` (in roles also a
line end ``\\n``).  Every backslash of escaped content is then followed by one of
these letters, so that undoing them in the reverse order is exact, and no control
string is left.  The parsed conversation is compared with its source once more
and the job fails if they ever differ.

The loss mask has a span for each assistant turn: turn number, first code point
and length inside the turn's rendered chunk.

Null texts and roles count as empty; a null turn comes first; rows of the same
turn are ordered by their rendering; a null conversation is one of its own;
repeated rows stay.  An empty table gives an empty result.  Extra columns are
ignored.  A conversation is one output row, so its rows meet in one task by
necessity; what must not grow with the corpus is the size of one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Strings that templates in use give a meaning to.
CONTROL = (START, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
LEARNED_ROLE = "assistant"


def _quote(s: str) -> str:
    return "\\Q" + s + "\\E"


def escape(text: Column, line_ends: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    out = F.replace(out, F.lit("<"), F.lit("\\l"))
    out = F.replace(out, F.lit("["), F.lit("\\s"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if line_ends else out


def unescape(text: Column, line_ends: bool = False) -> Column:
    out = F.replace(text, F.lit("\\n"), F.lit("\n")) if line_ends else text
    out = F.replace(out, F.lit("\\s"), F.lit("["))
    out = F.replace(out, F.lit("\\l"), F.lit("<"))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation: array<struct<role, text>>."""
    def turn(chunk):
        head = F.substring_index(chunk, "\n", 1)
        # what follows the role's line, without the closing marker and line end
        length = F.char_length(chunk) - F.char_length(head) - 1 - (len(END) + 1)
        body = F.substring(chunk, F.char_length(head) + 2, F.greatest(length, F.lit(0)))
        return F.struct(unescape(head, True).alias("role"), unescape(body).alias("text"))

    return F.transform(chunks(formatted), turn)


def chunks(formatted: Column) -> Column:
    """A rendered conversation's turns without their opening marker."""
    parts = F.split(formatted, _quote(START))
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``turns`` (parsed again),
    ``loss_mask`` array<struct<turn, start, length>>, ``n_escaped`` (turns that
    conflicted)."""
    control = "|".join(_quote(c) for c in CONTROL)
    t = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    same = F.array(F.struct(F.col("role"), F.col("text")))
    plain = _rendered(F.col("role"), F.col("text"))
    conflict = F.concat("role", F.lit("\n"), "text").rlike(control) | (parse(plain) != same)
    t = t.withColumn("conflict", conflict)
    role = F.when(F.col("conflict"), escape(F.col("role"), True)).otherwise(F.col("role"))
    text = F.when(F.col("conflict"), escape(F.col("text"))).otherwise(F.col("text"))
    t = t.select("conv_id", "turn", "conflict", "role", "text", role.alias("head"), text.alias("body"))
    t = t.select("conv_id", F.struct(
        "turn", _rendered(F.col("head"), F.col("body")).alias("chunk"), "role", "text", "conflict",
        (F.char_length("head") + 1).alias("start"), F.char_length("body").alias("length")).alias("t"))
    g = t.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    learned = F.filter(F.transform("ts", lambda x, i: F.when(x["role"] == LEARNED_ROLE, F.struct(
        i.alias("turn"), x["start"].alias("start"), x["length"].alias("length")))), lambda x: x.isNotNull())
    g = g.select("conv_id", "ts", F.array_join(F.transform("ts", lambda x: x["chunk"]), "").alias("formatted"),
                 learned.alias("loss_mask"))
    g = g.withColumn("turns", parse(F.col("formatted")))
    source = F.transform("ts", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    checked = F.when(F.col("turns") == source, F.col("turns")).otherwise(
        F.raise_error(F.concat(F.lit("round trip failed for conversation "), F.col("conv_id").cast("string")))
        .cast("array<struct<role:string,text:string>>"))
    return g.select("conv_id", "formatted", checked.alias("turns"), "loss_mask",
                    F.size(F.filter("ts", lambda x: x["conflict"])).alias("n_escaped"))


def loss_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    parts = chunks(formatted)
    return F.array_join(F.transform(loss_mask, lambda s: unescape(
        F.substring(F.get(parts, s["turn"]), s["start"] + 1, s["length"]))), "")
