r"""Chat formatting with a grammar round trip, in built-in expressions only.

The template writes a turn as ``[INST]role[/INST]text</s>``. Its grammar allows no control string
(``[INST] [/INST] <s> </s>``) inside a role or a text, so a parser that cuts at the control strings
is deterministic. A control string in the data is written with a backslash behind its first
character, and one that already has backslashes there with one more; the parser takes one off.

Every turn is rendered as it is and reparsed; if the parser doesn't give back the source, the turn
is escaped and tried again. The formatted conversation is reparsed as a whole once more.

Defined results: a null role or text counts as empty; rows without a conversation id form one
conversation with a null id; rows of one turn are ordered by role and text, null turns come first,
and repeated rows are repeated turns; an empty table gives no conversation. The text of one
conversation is one value, so a conversation has to fit into a row (2 GB); its rows are sorted by
Spark, which spills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, SHUT, END = "[INST]", "[/INST]", "</s>"
_CONTROL = r"[<\[]/?(?:s>|INST\])"
_TO_ESCAPE = r"([<\[])(\\*)(/?(?:s>|INST\]))"
_ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _TO_ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(SHUT), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of a formatted conversation; null if it breaks the grammar."""
    pieces = F.split(formatted, END, -1)
    closed = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    head = lambda piece: F.substring_index(piece, SHUT, 1)

    def turn(piece: Column) -> Column:
        role = F.substr(head(piece), F.lit(len(OPEN) + 1))
        text = F.substr(piece, F.length(head(piece)) + len(SHUT) + 1)
        proper = (
            piece.startswith(OPEN)
            & piece.contains(SHUT)
            & ~role.rlike(_CONTROL)
            & ~text.rlike(_CONTROL)
        )
        return F.when(proper, F.struct(unescape(role).alias("role"), unescape(text).alias("text")))

    turns = F.transform(closed, turn)
    whole = (F.element_at(pieces, -1) == "") & ~F.exists(turns, lambda t: t.isNull())
    return F.when(whole, turns)


def rendered_turn(role: Column, text: Column) -> Column:
    """The turn as it is if it can be read back, else escaped.

    One escape is enough: afterwards no control string is left inside, and each one that the parser
    restores is one that was escaped.
    """
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    plain = render(role, text)
    return F.when(parse(plain).eqNullSafe(source), plain).otherwise(
        render(escape(role), escape(text))
    )


def format_chats(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learned_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, n_turns, loss_spans, identical``.

    ``loss_spans`` lists start (from 0) and length, in characters of ``formatted``, of the texts of
    ``learned_role`` in their order, without their markers: what a loss mask covers. ``identical``
    tells that reparsing ``formatted`` gives the source's turns.
    """
    turn = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("rendered", rendered_turn(F.col("role"), F.col("text")))
    upto = (
        Window.partitionBy("conv_id")
        .orderBy("turn", "role", "text")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    size = F.length("rendered")
    head = F.length(F.substring_index("rendered", SHUT, 1)) + len(SHUT)
    placed = turn.withColumn("start", F.sum(size.cast("bigint")).over(upto) - size).select(
        "conv_id",
        F.struct(
            "start",
            (F.col("start") + head).alias("text_start"),
            (size - head - len(END)).alias("text_length"),
            "role",
            "text",
            "rendered",
        ).alias("t"),
    )
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    made = whole.select(
        "conv_id",
        F.array_join(F.transform("ts", lambda t: t["rendered"]), "").alias("formatted"),
        F.transform(
            F.filter("ts", lambda t: t["role"] == learned_role),
            lambda t: F.struct(
                t["text_start"].alias("start"), t["text_length"].cast("bigint").alias("length")
            ),
        ).alias("loss_spans"),
        F.transform(
            "ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
        ).alias("source"),
    )
    return made.select(
        "conv_id",
        "formatted",
        F.size("source").cast("bigint").alias("n_turns"),
        "loss_spans",
        parse(F.col("formatted")).eqNullSafe(F.col("source")).alias("identical"),
    )


def spanned_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the spans, in order."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(
                F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
            ),
        ),
        "",
    )
