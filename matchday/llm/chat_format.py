"""Chat formatting: each conversation as one text with marked turns, and the spans of it that are under the loss mask.

Turn structs are collected and sorted per conversation, adjacent turns of one role are merged into one block with array
functions, and the text is concatenated; Spark expressions only.

The template writes a block as ``### role:`` and a new line, then each of its texts followed by ``</turn>`` and a new line. In
a text, a backslash comes behind each backslash, each ``#`` that begins ``###`` and each ``<`` that begins ``</turn>``, so no
control string of the template stands in an escaped text, and dropping a backslash before any character gives the text again.
A role is escaped alike, and before a new line that follows a colon too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.tables import table

# --- fixed values of the template ---------------------------------------------
OPEN, ROLE_END, TURN_END = "### ", ":\n", "</turn>\n"
LOSS_ROLE = "assistant"
# ------------------------------------------------------------------------------
_CONTROL = r"(\\|#(?=##)|<(?=/turn>))"
_ROLE_CONTROL = r"(\\|#(?=##)|<(?=/turn>)|:(?=\n))"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.transform(F.array(value), body)[0]


def escaped(text: Column, control: str = _CONTROL) -> Column:
    return F.regexp_replace(text, control, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _cut(items: Column, width: Column) -> Column:
    """The array in slices of ``width``; an empty array gives none."""
    return F.when(F.size(items) == 0, F.slice(F.array(items), 2, 1)).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(items), width), lambda s: F.slice(items, s, width)))


def _root(items: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(items))).cast("int"))


def ends_of(lengths: Column) -> Column:
    """Running sums of an array of bigint, in steps of the square root of its size, so that no long array is copied per item."""
    def sums(part: Column) -> Column:
        none = F.slice(F.array(F.lit(0).cast("long")), 2, 1)
        return F.aggregate(part, none, lambda acc, x: F.array_append(acc, F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + x))

    last = lambda part: F.get(part, F.size(part) - 1)
    return _let(F.transform(_cut(lengths, _root(lengths)), sums), lambda parts: _let(
        sums(F.transform(parts, last)), lambda totals: F.flatten(F.transform(
            parts, lambda part, i: F.transform(part, lambda x: x + F.coalesce(F.get(totals, i - 1), F.lit(0)))))))


def blocks_of(turns: Column) -> Column:
    """Sorted turns (role, text) as blocks: role, texts of adjacent turns of that role."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size(turns) - 1), lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))
    return _let(starts, lambda at: F.transform(at, lambda s, k: F.struct(
        F.get(turns, s)["role"].alias("role"),
        F.transform(F.slice(turns, s + 1, F.coalesce(F.get(at, k + 1), F.size(turns)) - s), lambda t: t["text"]).alias("texts"))))


def _pieces(blocks: Column, loss_role: str) -> Column:
    """The pieces of the formatted text in order: text, and whether it is under the loss mask."""
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.flatten(F.transform(blocks, lambda b: F.concat(
        F.array(piece(F.concat(F.lit(OPEN), escaped(b["role"], _ROLE_CONTROL), F.lit(ROLE_END)), F.lit(False))),
        F.flatten(F.transform(b["texts"], lambda t: F.array(
            piece(escaped(t), b["role"] == F.lit(loss_role)), piece(F.lit(TURN_END), F.lit(False))))))))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row for each conversation: its id (named ``conv``), formatted, loss_spans (array of start, end in code points, end
    exclusive; the whole text of each turn of ``loss_role``, escaped, nothing else).

    Turns are in the order of ``turn``, then role, then text; nulls come first. A null role or text counts as empty, a null id
    is a conversation of its own, and repeated rows stay. An empty table gives an empty result; other columns are not looked at.
    A conversation is one row of the result, so it is gathered in one task; the work on it grows with its turns and characters
    (the running sums by a power of 1.5 of its turns).
    """
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    each = turns.select(F.col(f"`{conv}`").alias("_conv"), F.struct(
        F.col(f"`{turn}`").alias("turn"), blank(role).alias("role"), blank(text).alias("text")).alias("_turn"))
    chats = each.groupBy("_conv").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    pieces = chats.select("_conv", _pieces(blocks_of(F.col("_turns")), loss_role).alias("_pieces"))
    spans = _let(ends_of(F.transform("_pieces", lambda p: F.length(p["text"]).cast("long"))), lambda ends: F.filter(
        F.transform("_pieces", lambda p, i: F.when(p["loss"], F.struct(
            (F.get(ends, i) - F.length(p["text"])).alias("start"), F.get(ends, i).alias("end")))),
        lambda s: s.isNotNull()))
    return pieces.select(
        F.col("_conv").alias(conv), F.array_join(F.transform("_pieces", lambda p: p["text"]), "").alias("formatted"),
        spans.alias("loss_spans"))


def turns_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text holds."""
    blocks = F.filter(F.split(formatted, rf"(?<=\A|</turn>\n){OPEN}", -1), lambda b, i: i > 0)

    def read(block: Column) -> Column:
        header = F.substring_index(block, ROLE_END, 1)
        texts = F.split(F.substr(block, F.length(header) + F.lit(len(ROLE_END) + 1)), TURN_END, -1)
        return _let(header, lambda h: _let(texts, lambda ts: F.transform(
            F.slice(ts, 1, F.size(ts) - 1), lambda t: F.struct(unescaped(h).alias("role"), unescaped(t).alias("text")))))

    return F.flatten(F.transform(blocks, read))


def texts_under(formatted: Column, spans: Column) -> Column:
    """The unescaped text of each span. A text is cut in steps: around some spans first, then each of them."""
    def read(part: Column) -> Column:
        start, end = F.get(part, 0)["start"], F.get(part, F.size(part) - 1)["end"]
        return _let(F.struct(start.alias("at"), F.substr(formatted, (start + 1).cast("int"), (end - start).cast("int")).alias("text")),
                    lambda x: F.transform(part, lambda s: unescaped(F.substr(
                        x["text"], (s["start"] - x["at"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))))

    return F.flatten(F.transform(_cut(spans, _root(spans)), read))


def digests(chats: DataFrame) -> DataFrame:
    """The contract's columns, read back from formatted texts and their loss spans."""
    joined = lambda parts: F.array_join(parts, "")
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    read = chats.select(
        "conv_id", "formatted", turns_back(F.col("formatted")).alias("_turns"),
        joined(texts_under(F.col("formatted"), F.col("loss_spans"))).alias("_loss"))
    return read.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"),
        sha(joined(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), sha(F.col("_loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: The further conversation of the query's contract.
EXTRA_ID, EXTRA_TEXT = -7, r"\### Assistant: </turn> ok"


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(EXTRA_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TEXT).alias("text"))
    return digests(format_chats(turns.unionByName(extra)))


ORACLE_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT {EXTRA_ID}, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '{EXTRA_TEXT}' FROM range(2) r(i)
), p AS (
  SELECT *, lag(role) OVER w AS before, row_number() OVER w AS k FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, t)
), x AS (
  SELECT *, length(t) + length(t) - length(replace(t, '\', ''))
           + coalesce(list_sum(list_transform(regexp_extract_all(t, '#{{3,}}'), lambda r: length(r) - 2)), 0)
           + (length(t) - length(replace(t, '</turn>', ''))) // 7 + 8
           + CASE WHEN k = 1 OR role <> before THEN length(role) + 6 ELSE 0 END AS chars FROM p
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(t)) FILTER (role = '{LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY k) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id
"""
