"""Chat texts from logs of conversation events, with DataFrame functions only.

A log has one row per event: ``message`` (a whole text), ``delta`` (a piece that a stream
appends to its turn), ``edit`` (a new text for the turn) and ``regenerate`` (the turn's text
so far is dropped, what follows builds it anew). Rows are dealt by (conversation, turn),
each turn's events are sorted by sequence number and folded to its final text, and only
these final texts meet in the row of their conversation, sorted by turn.

The template marks a turn as ``<turn ROLE>TEXT</turn>`` and the trained text inside it as
``<loss>TEXT</loss>``. Inside roles and texts a backslash is doubled, ``<`` becomes ``\\l`` and
``>`` becomes ``\\g``: no mark can arise from a text, and reading turns them back exactly.

Defined cases: a null text is empty, a null kind is a message, a null role is empty and a
null turn comes first; rows with the same turn and sequence are folded in the order of
kind, text and role, and a row that occurs twice counts twice, so a later message replaces
an earlier one of its turn; messages of a table without events (``numbered``) are all kept,
those of the same turn in the order of role and text; a turn's role is that of
its last event; a null conversation is a conversation; no events, no conversations. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TURN_END = "<turn ", "</turn>"
LOSS, LOSS_END = "<loss>", "</loss>"


#: What stands for the characters of marks; the backslash itself comes first.
ESCAPES = (("\\", "\\\\"), ("<", "\\l"), (">", "\\g"))


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``.

    A run of backslashes begins at an escape, so splitting at pairs from the left finds the
    doubled ones; in the parts between them each backslash begins one of the other escapes.
    """

    def part(piece: Column) -> Column:
        for plain, code in ESCAPES[1:]:
            piece = F.replace(piece, F.lit(code), F.lit(plain))
        return piece

    return F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")


def numbered(messages: DataFrame, into: str = "part") -> DataFrame:
    """Whole messages with their number among those of the same conversation and turn."""
    order = [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")]
    return messages.withColumn(into, F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy(*order)))


def folded(
    events: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    seq: str = "seq",
    kind: str = "kind",
    role: str = "role",
    text: str = "text",
    part: str | None = None,
) -> DataFrame:
    """The final messages: conv_id, turn, role, text; one row per turn that has events.

    ``part`` names a column that tells messages of the same turn apart, ``part`` in the result.
    Messages and edits replace all before them and ``regenerate`` drops it, so a turn's text
    is the concatenation of what follows its last such event, that event's text included.
    """
    event = F.struct(
        F.col(seq).alias("seq"),
        F.coalesce(F.col(kind), F.lit("message")).alias("kind"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
    )
    keys = {"conv_id": conv, "turn": turn} | ({"part": part} if part else {})
    rows = events.select(*[F.col(c).alias(key) for key, c in keys.items()], event.alias("event"))
    turns = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("event")).alias("events"))
    # Counted from the end: the last event that does not merely append.
    back = F.array_position(F.transform(F.reverse("events"), lambda e: e["kind"] != "delta"), True)
    start = F.when(back == 0, 1).otherwise(F.size("events") - back + 1).cast("int")
    tail = F.slice("events", start, F.size("events"))
    texts = F.transform(tail, lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"]))
    role_of = F.element_at("events", -1)["role"]
    return turns.select(*keys, role_of.alias("role"), F.array_join(texts, "").alias("text"))


def rendered(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """conv_id, formatted: the messages of each conversation in order of turn.

    Each message is rendered before the shuffle; conversations meet as rendered texts.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    body = F.when(role == trained_role, F.concat(F.lit(LOSS), escaped(text), F.lit(LOSS_END))).otherwise(escaped(text))
    block = F.concat(F.lit(TURN), escaped(role), F.lit(">"), body, F.lit(TURN_END))
    rows = messages.select("conv_id", F.struct("turn", block.alias("block")).alias("row"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return grouped.select("conv_id", F.array_join(F.col("rows.block"), "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """The array of (role, text, loss) that a formatted text holds."""
    blocks = F.split(formatted, F.lit(TURN_END))
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def message(block: Column) -> Column:
        role = F.substring_index(F.substring(block, F.lit(len(TURN) + 1), F.length(block)), ">", 1)
        body = F.substring(block, F.length(role) + len(TURN) + 2, F.length(block))
        loss = F.startswith(body, F.lit(LOSS))
        inner = F.substring(body, F.lit(len(LOSS) + 1), F.length(body) - len(LOSS) - len(LOSS_END))
        text = F.when(loss, inner).otherwise(body)
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"), loss.alias("loss"))

    return F.transform(blocks, message)
