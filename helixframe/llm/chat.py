"""Chat formatting with Spark expressions only.

A message is `### role: text</turn>` and a line end. Turns that follow one
another in the same role share a message, their texts parted by `<part>`.
Inside roles and texts a backslash becomes `\\s`, `#` becomes `\\h`, `<`
becomes `\\l`, and in roles `:` becomes `\\c`: no marker can occur in them,
every backslash starts an escape, and both are read back exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END, PART = "</turn>\n", "<part>"


def _replaced(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def escaped(c: Column) -> Column:
    return _replaced(c, [("\\", "\\s"), ("#", "\\h"), ("<", "\\l")])


def unescaped(c: Column) -> Column:
    return _replaced(c, [("\\c", ":"), ("\\l", "<"), ("\\h", "#"), ("\\s", "\\")])


def bound(value: Column, kind: str, body: Callable[[Column], Column]) -> Column:
    """body(value), of a type, with value worked out once: an aggregate over one element."""
    return F.aggregate(F.array(value), F.lit(None).cast(kind), lambda _, x: body(x))


def in_blocks(values: Column, block: Callable[[Column], Column]) -> Column:
    """block() of every slice of about the square root of values' length; values must have some."""
    width = F.ceil(F.sqrt(F.size(values))).cast("int")
    return F.transform(F.sequence(F.lit(0), F.size(values) - 1, width), lambda at: block(F.slice(values, at + 1, width)))


def running_sums(values: Column) -> Column:
    """The sums of an array of whole numbers before each of its places.

    An aggregate that appends copies what it has at every step; so sums are
    made in blocks of about the square root of the length, and then over the blocks."""

    def sums(block: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("before"))
        return F.aggregate(block, zero, lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.array_append(s["before"], s["sum"]).alias("before")))

    joined = lambda blocks: F.flatten(F.zip_with(blocks, sums(F.transform(blocks, lambda b: b["sum"]))["before"], lambda b, base: F.transform(b["before"], lambda x: x + base)))
    whole = lambda v: F.when(F.size(v) > 0, bound(in_blocks(v, sums), "array<bigint>", joined)).otherwise(F.array().cast("array<bigint>"))
    return bound(values, "array<bigint>", whole)


def format_chats(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """(conv_col, formatted, mask) per conversation. mask holds the spans
    (start from 1, length, in code points of formatted) of the texts to learn,
    those of loss_role.

    Turns go by turn_col, a null turn first; ties by role and text, so that
    repeated rows stay and their order is settled. Null roles and texts count
    as empty. Rows of a null conv_col form one conversation. Other columns are
    not read; no rows give no conversations. One conversation makes one row,
    so it has to fit into memory, as its formatted text does."""
    turn = F.struct(F.col(turn_col).alias("at"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chats = rows.select(F.col(conv_col).alias("conv"), turn.alias("turn")).groupBy("conv").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    role = lambda i: F.get("turns", i)["role"]
    head = lambda t: F.concat(F.lit("### "), F.replace(escaped(t["role"]), F.lit(":"), F.lit("\\c")), F.lit(": "))

    def piece(t: Column, i: Column) -> Column:
        goes_on = F.coalesce(role(i - 1) == t["role"], F.lit(False))  # the first turn has none before it
        ends = F.coalesce(role(i + 1) != t["role"], F.lit(True))
        return F.struct((t["role"] == loss_role).alias("learn"), F.when(goes_on, F.lit(PART)).otherwise(head(t)).alias("lead"), escaped(t["text"]).alias("text"), F.when(ends, F.lit(END)).otherwise(F.lit("")).alias("tail"))

    chats = chats.select("conv", F.transform("turns", piece).alias("pieces"))
    whole = lambda p: F.concat(p["lead"], p["text"], p["tail"])
    chats = chats.select("conv", "pieces", F.array_join(F.transform("pieces", whole), "").alias("formatted"), running_sums(F.transform("pieces", lambda p: F.length(whole(p)))).alias("before"))
    spans = F.zip_with("pieces", "before", lambda p, at: F.struct(p["learn"].alias("learn"), (at + F.length(p["lead"]) + 1).cast("int").alias("start"), F.length(p["text"]).alias("length")))
    mask = F.transform(F.filter(spans, lambda x: x["learn"]), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))
    return chats.select(F.col("conv").alias(conv_col), "formatted", mask.alias("mask"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted chat was made of."""
    messages = F.filter(F.split(formatted, F.lit(END), -1), lambda m: m != "")
    parts = F.transform(messages, lambda m: F.split(m, F.lit(": "), 2))
    return F.flatten(F.transform(parts, lambda p: F.transform(F.split(p[1], F.lit(PART), -1), lambda t: F.struct(unescaped(F.substring(p[0], 5, 1 << 30)).alias("role"), unescaped(t).alias("text")))))


def read_loss(formatted: Column, mask: Column) -> Column:
    """The unescaped text under the mask. A substring is found by counting
    characters, so spans are read from the part of the text that a block of them lies in."""

    def block(spans: Column) -> Column:
        first, last = spans[0], F.element_at(spans, -1)
        part = F.substr(formatted, first["start"], last["start"] + last["length"] - first["start"])
        return bound(part, "string", lambda p: F.array_join(F.transform(spans, lambda s: unescaped(F.substr(p, s["start"] - first["start"] + 1, s["length"]))), ""))

    return F.when(F.size(mask) > 0, F.array_join(in_blocks(mask, block), "")).otherwise("")


def chat_digests(rows: DataFrame) -> DataFrame:
    """What is read back from the formatted conversations, as digests."""
    chats = format_chats(rows)
    chats = chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("mask")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: The conversation whose texts hold the template's own marks.
TRICKY_ID, TRICKY_TEXT = -7, "\\### Assistant: </turn> ok"


def tricky(spark) -> DataFrame:
    rows = [(TRICKY_ID, 0, "user", TRICKY_TEXT), (TRICKY_ID, 1, "assistant", TRICKY_TEXT)]
    parts = [F.struct(F.lit(c).cast("long").alias("conv_id"), F.lit(n).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(t).alias("text")) for c, n, r, t in rows]
    return spark.range(1).select(F.inline(F.array(*parts)))


SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
near AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
    replace(replace(replace(text, '\', '\s'), '#', '\h'), '<', '\l') AS body,
    replace(replace(replace(replace(role, '\', '\s'), '#', '\h'), '<', '\l'), ':', '\c') AS head
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
pieces AS (
  SELECT *, CASE WHEN before = role THEN '<part>' ELSE '### ' || head || ': ' END || body ||
    CASE WHEN after = role THEN '' ELSE '</turn>' || chr(10) END AS piece FROM near),
chats AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length(piece)) AS formatted_chars FROM pieces GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM chats
"""
