"""Conversations as training text that can be read back, with a mask of what to learn.

A turn is written as ``### role: text</turn>`` and a line end; a conversation is its
turns one after another. The grammar is deterministic::

    conversation = turn*
    turn         = "### " role ": " text "</turn>" newline
    role, text   = any characters in which a backslash before a backslash or before a
                   control string stands for what follows it; a role has no ": ", a
                   text no "### " and no "</turn>" without a backslash before it

A text that holds no control string is written as it is. Whether that is right is not
guessed: each turn is written, parsed again and compared with its source, and if the two
differ it is written with more escapes until they are identical: as it is, then with a
backslash before control strings, at last before backslashes too, which is always
reversible. Each turn written so parses as exactly one turn, and so does each of a row of
them; the whole conversation is parsed once more and compared before it is returned.

All of it is column expressions. Turns are escaped before anything moves; one shuffle by
conversation brings them together. A conversation is one row of the result, so its text
has to fit a row (2 GB); it isn't held in any other form.

Null texts and roles are empty; bytes that are no UTF-8 become U+FFFD. Turns are ordered by
turn (null first), then role, then text, so repeated rows are turns each. Rows without a
conversation id make one conversation with a null id. An empty table gives an empty
result. Other columns of the table are not used, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPENS, SAYS, CLOSES = "### ", ": ", "</turn>\n"

# Possessive repeats: Java runs them as loops, so long texts don't deepen its stack.
_ROLE = r"(?:[^\\:]++|\\\\|\\: |\\|:(?! ))*+"
_TEXT = r"(?:[^\\#<]++|\\\\|\\### |\\</turn>|\\|#(?!## )|<(?!/turn>))*+"
TURN = rf"### ({_ROLE}): ({_TEXT})</turn>\n"

_ROLE_CONTROLS, _TEXT_CONTROLS = ": ", "### |</turn>"


def escaped(value: Column, controls: str, level: int) -> Column:
    """``value`` as it is (0), with ``controls`` escaped (1), with backslashes too (2)."""
    if level == 0:
        return value
    found = controls if level == 1 else rf"\\|{controls}"
    return F.regexp_replace(value, f"({found})", r"\\$1")


def unescaped(value: Column, controls: str) -> Column:
    return F.regexp_replace(value, rf"\\(\\|{controls})", "$1")


def role_of(written: Column) -> Column:
    return unescaped(written, _ROLE_CONTROLS)


def text_of(written: Column) -> Column:
    return unescaped(written, _TEXT_CONTROLS)


def _written(role: Column, text: Column, level: int) -> Column:
    return F.struct(
        F.concat(F.lit(OPENS), escaped(role, _ROLE_CONTROLS, level), F.lit(SAYS)).alias("head"),
        escaped(text, _TEXT_CONTROLS, level).alias("body"),
    )


def _whole(written: Column) -> Column:
    return F.concat(written["head"], written["body"], F.lit(CLOSES))


def _reads_as(written: Column, role: Column, text: Column) -> Column:
    """Whether the written turn parses as one turn, with this role and text."""
    line = _whole(written)
    at = {group: F.regexp_extract(line, f"^{TURN}$", group) for group in (0, 1, 2)}
    return (at[0] == line) & (role_of(at[1]) == role) & (text_of(at[2]) == text)


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (``role``, ``text``); null if
    it isn't a sequence of turns."""
    roles, texts = (F.regexp_extract_all(formatted, F.lit(TURN), F.lit(g)) for g in (1, 2))
    turns = F.transform(
        F.arrays_zip(roles.alias("role"), texts.alias("text")),
        lambda t: F.struct(role_of(t["role"]).alias("role"), text_of(t["text"]).alias("text")),
    )
    return F.when(F.regexp_replace(formatted, TURN, "") == "", turns)


def learnt(formatted: Column, loss: Column) -> Column:
    """The texts under the mask, unescaped, one per span."""
    raw = formatted.cast("binary")

    def one(span: Column) -> Column:
        size = (span["byte_end"] - span["byte_start"]).cast("int")
        return text_of(F.substring(raw, (span["byte_start"] + 1).cast("int"), size).cast("string"))

    return F.transform(loss, one)


def format_chats(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id under its own name, ``n_turns``, ``formatted`` and
    ``loss``, an array of spans (``start``, ``end`` in code points, ``byte_start``,
    ``byte_end`` in UTF-8 bytes, ends exclusive) of the texts whose role is ``learn``."""
    valid = {c: F.make_valid_utf8(F.coalesce(F.col(f"`{c}`"), F.lit(""))) for c in (role, text)}
    turns = rows.select(
        F.col(f"`{conversation}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        valid[role].alias("role"),
        valid[text].alias("text"),
    )
    source = F.col("role"), F.col("text")
    choice = _written(*source, 2)
    for level in (1, 0):
        written = _written(*source, level)
        choice = F.when(_reads_as(written, *source), written).otherwise(choice)
    written = turns.withColumn("written", choice).select(
        "conv", "turn", "role", "text", "written", _whole(F.col("written")).alias("line")
    )
    # Where each turn starts, from the turns before it: a running sum, so that a long
    # conversation costs no more a turn than a short one.
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = written.select(
        "conv",
        "role",
        "text",
        "written",
        "line",
        F.coalesce(F.sum(F.length("line")).over(before), F.lit(0)).alias("at"),
        F.coalesce(F.sum(F.octet_length("line")).over(before), F.lit(0)).alias("byte_at"),
    )

    def span(size) -> dict[str, Column]:
        return {"head": size(F.col("written.head")), "body": size(F.col("written.body"))}

    chars, octets = span(F.length), span(F.octet_length)
    mask = F.when(
        F.col("role") == learn,
        F.struct(
            (F.col("at") + chars["head"]).alias("start"),
            (F.col("at") + chars["head"] + chars["body"]).alias("end"),
            (F.col("byte_at") + octets["head"]).alias("byte_start"),
            (F.col("byte_at") + octets["head"] + octets["body"]).alias("byte_end"),
        ),
    )
    gathered = placed.groupBy("conv").agg(
        F.array_sort(
            F.collect_list(F.struct("at", "line", "role", "text", mask.alias("span")))
        ).alias("turns")
    )
    formatted = F.array_join(F.col("turns.line"), "")
    made = gathered.select(
        "conv",
        F.size("turns").cast("long").alias("n_turns"),
        formatted.alias("formatted"),
        F.array_compact("turns.span").alias("loss"),
        F.transform(
            "turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
        ).alias("source"),
    )
    same = F.coalesce(parse(F.col("formatted")) == F.col("source"), F.lit(False))
    broken = F.raise_error(F.lit("a formatted conversation does not read back as its source"))
    return made.select(
        F.col("conv").alias(conversation),
        "n_turns",
        F.when(same, F.col("formatted")).otherwise(broken.cast("string")).alias("formatted"),
        "loss",
    )
