r"""Chat formatting checked by parsing it back, in built-in functions alone.

Grammar of a formatted conversation::

    conversation = turn*
    turn         = "<s>[" tag "] " body " [/" tag "]</s>"
    tag          = "INST" (user) | "ANS" (assistant) | "SYS" (system) | "ROLE:" hex of any other role in UTF-8
    body         = text without control strings; "\" before a character stands for that character alone

Control strings are ``<s>``, ``</s>``, ``[INST]``, ``[/INST]`` and so on, and the beginnings ``[ROLE:`` and ``[/ROLE:``.
The parser splits at ``</s>``, reads the tag, cuts head and tail, and takes no body that holds a control string. A
conversation is first rendered as it is and parsed; a turn that does not come back (it holds a control string, or a
backslash that the parser would drop) is escaped: each backslash is doubled and each control string gets a backslash after
its first character. The result is parsed again and compared; if it still differed, the job would end with an error.

Cases: null text or role counts as empty. Turns are ordered by (turn, role, text), nulls first, so ties and repeated rows
have one result. Rows with a null id form one conversation. An empty table gives an empty result. Other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A bracket and what may follow it in a control string. Wider than the grammar needs: ``<INST]`` is escaped as well.
CONTROL = r"([<\[])(/?(?:s>|INST\]|SYS\]|ANS\]|ROLE:))"
TAGS = {"user": "INST", "assistant": "ANS", "system": "SYS"}


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\$2")


def unescape(body: Column) -> Column:
    return F.regexp_replace(body, r"(?s)\\(.)", "$1")


def _tag(role: Column) -> Column:
    out = F.concat(F.lit("ROLE:"), F.hex(role.cast("binary")))
    for name, tag in TAGS.items():
        out = F.when(role == name, F.lit(tag)).otherwise(out)
    return out


def _role(tag: Column) -> Column:
    out = F.decode(F.unhex(F.substr(tag, F.lit(6))), "UTF-8")
    for name, short in TAGS.items():
        out = F.when(tag == short, F.lit(name)).otherwise(out)
    return out


def _render(turn: Column, body: Column) -> Column:
    tag = _tag(turn["role"])
    return F.concat(F.lit("<s>["), tag, F.lit("] "), body, F.lit(" [/"), tag, F.lit("]</s>"))


def _parse_turn(piece: Column) -> Column:
    """Role and text of one turn without its ``</s>``; a null text where the grammar does not hold."""
    tag = F.regexp_extract(piece, r"^<s>\[([A-Z]+|ROLE:[0-9A-F]*)\] ", 1)
    head, tail = F.length(tag) + 6, F.length(tag) + 4
    body = F.substr(piece, head + 1, F.length(piece) - head - tail)
    fits = (
        (tag != "")
        & (F.length(piece) >= head + tail)
        & F.endswith(piece, F.concat(F.lit(" [/"), tag, F.lit("]")))
        & ~F.regexp_like(body, F.lit(CONTROL))
    )
    return F.struct(F.when(fits, _role(tag)).alias("role"), F.when(fits, unescape(body)).alias("text"))


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation."""
    pieces = F.split(formatted, "</s>")
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), _parse_turn)


def format_conversations(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: ``id_col``, ``formatted``, ``n_escaped`` (turns that needed escapes)."""
    blank = F.lit("")
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), blank).alias("role"),
        F.coalesce(F.col(text_col), blank).alias("text"),
    )
    told = rows.groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    source = F.transform("turns", lambda t: F.struct(t["role"], t["text"]))

    def comes_back(t: Column) -> Column:
        whole = _render(t, t["text"])
        return _parse_turn(F.substr(whole, F.lit(1), F.length(whole) - 4)).eqNullSafe(t)

    told = told.withColumn("turns", source).withColumn("conflict", F.transform("turns", lambda t: ~comes_back(t)))
    first = F.array_join(F.transform("turns", lambda t: _render(t, t["text"])), "")
    escaped = F.array_join(
        F.zip_with("turns", "conflict", lambda t, bad: _render(t, F.when(bad, escape(t["text"])).otherwise(t["text"]))), ""
    )
    out = told.withColumn("formatted", F.when(F.exists("conflict", lambda x: x), escaped).otherwise(first))
    same = parse(F.col("formatted")).eqNullSafe(F.col("turns"))
    checked = F.when(same, F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("conversation does not come back: "), F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    )
    return out.select(
        F.col("id").alias(id_col), checked.alias("formatted"), F.size(F.filter("conflict", lambda x: x)).alias("n_escaped")
    )


def loss_mask(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Spans of assistant bodies in ``formatted``: id, turn_no, start and length in code points from 0."""
    from pyspark.sql import Window

    pieces = F.split("formatted", "</s>")
    turns = formatted.select(id_col, F.posexplode(F.slice(pieces, 1, F.size(pieces) - 1)).alias("turn_no", "piece"))
    before = Window.partitionBy(id_col).orderBy("turn_no").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("piece") + 4).over(before), F.lit(0))
    return (
        turns.withColumn("at", at)
        .filter(F.col("piece").startswith("<s>[ANS] "))
        .select(id_col, "turn_no", (F.col("at") + 9).alias("start"), (F.length("piece") - 16).alias("length"))
    )
