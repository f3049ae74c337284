"""Conversations as training windows of a token budget, in DataFrame functions only.

Prefix sums of turn tokens cut a conversation into spans of whole turns. Every window shows the system
turn, a limited history of turns from before its span, and the span itself. Only assistant texts of the
span are targets; those repeated as history are masked.

A turn is written ``<turn ROLE>TEXT</turn>`` and a line feed. In roles and texts ``&``, ``<`` and ``>`` are
written ``&amp;``, ``&lt;`` and ``&gt;``, so no text can hold a mark, and undoing it in reverse order gives
the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, HISTORY = 1024, 128
#: A turn's tokens are estimated: its marks, and one for every four characters as written, that is escaped.
MARK_TOKENS, CHARS_PER_TOKEN = 8, 4
_HEAD_START = -(10**12)  # out of every history's reach
#: Spans are cut in blocks of so many rooms, each on its own; what is gathered to cut one is bounded by that.
BLOCK_ROOMS = 16
#: Any two spans in a row pass the room, so a block has fewer spans than this.
SPANS_IN_BLOCK = 64


def escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def unescaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&gt;"), F.lit(">")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _written(turn: Column) -> Column:
    return F.concat(F.lit("<turn "), escaped(turn["role"]), F.lit(">"), escaped(turn["text"]), F.lit("</turn>\n"))


def _span_starts() -> Column:
    """Numbers (from 1) of the turns that open a span: the block's first, and each that would take its span past the room."""
    start = F.struct(
        F.lit(0).alias("n"), F.col("turns")[0]["begin"].alias("from"), F.array(F.lit(1)).alias("starts")
    )

    def read(s, t):
        opens = (t["begin"] > s["from"]) & (t["begin"] + t["counted"] - s["from"] > F.col("room"))
        return F.struct(
            (s["n"] + 1).alias("n"), F.when(opens, t["begin"]).otherwise(s["from"]).alias("from"),
            F.when(opens, F.array_append(s["starts"], s["n"] + 1)).otherwise(s["starts"]).alias("starts"),
        )

    return F.aggregate("turns", start, read, lambda s: s["starts"])


def _spans(history: int) -> Column:
    """Each span's turns, and the turns of the history before it, of this block or of the one before."""
    seen = F.concat(
        F.coalesce("past", F.array()),
        F.transform("turns", lambda t: F.struct(*[t[c].alias(c) for c in ("pos", "at", "role", "text")])),
    )

    def cut(first, k):
        after = F.coalesce(F.get("starts", k + 1), F.size("turns") + 1)
        begin = F.get("turns", first - 1)["begin"]
        return F.struct(
            F.slice("turns", first, after - first).alias("span"),
            F.filter(seen, lambda t: (t["at"] >= begin - history) & (t["at"] < begin)).alias("past"),
        )

    return F.transform("starts", cut)


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Training windows: conv_id, window (from 0, may skip), formatted, n_repeated, loss.

    Needs conv_id, turn, role and text; other columns are not read. Turns follow ``turn``, equal ones role
    and text; repeated rows are turns of their own. Null texts and roles are empty, null turns come first, and
    rows without conv_id form one conversation. The first turn counts as system turn if its role is
    ``system``. ``n_repeated`` leading turns were shown before; ``loss`` lists (start from 1, length) of the
    targets in code points of ``formatted``. A span takes turns as long as they fit beside system turn and
    history, so only a window whose span is one turn can pass the budget; no turn is cut or dropped. Empty
    table: empty result.

    Scale: one shuffle by conversation; prefix sums and histories are window functions over sorted rows
    that spill. Prefix sums deal turns to blocks of BLOCK_ROOMS rooms, in which spans are cut greedily: what is
    gathered is one block's turns, whatever the conversation's length.
    """
    text = F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    turns = turns.withColumn(
        "tokens", (F.ceil(F.char_length(escaped(F.col("text"))) / CHARS_PER_TOKEN) + MARK_TOKENS).cast("long")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = turns.withColumn("pos", F.row_number().over(order))
    turns = turns.withColumn("is_head", (F.col("pos") == 1) & (F.col("role") == "system"))
    by_pos = Window.partitionBy("conv_id").orderBy("pos")
    turns = turns.withColumn("counted", F.when(F.col("is_head"), F.lit(0)).otherwise(F.col("tokens")))
    turns = turns.withColumn(
        "head", F.first(F.when(F.col("is_head"), F.struct("role", "text", "tokens")), ignorenulls=False).over(by_pos)
    ).withColumn("begin", F.sum("counted").over(by_pos) - F.col("counted"))
    turns = turns.withColumn("at", F.when(F.col("is_head"), F.lit(_HEAD_START)).otherwise(F.col("begin")))
    room = F.greatest(F.lit(1), budget - history - F.coalesce(F.col("head")["tokens"], F.lit(0)))
    turns = turns.withColumn("room", room).withColumn("block", F.floor(F.col("begin") / (BLOCK_ROOMS * F.col("room"))))
    before = Window.partitionBy("conv_id").orderBy("at").rangeBetween(-history, -1)
    turns = turns.withColumn(
        "past", F.collect_list(F.struct("pos", "at", "role", "text")).over(before)
    ).withColumn("past", F.when(~F.col("block").eqNullSafe(F.lag("block").over(by_pos)), F.col("past")))
    blocks = turns.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("pos", "at", "begin", "counted", "role", "text", "is_head"))).alias("turns"),
        F.min_by("past", "pos").alias("past"), F.first("head").alias("head"), F.first("room").alias("room"),
    )
    spans = blocks.withColumn("starts", _span_starts()).select(
        "conv_id", "block", "head", F.posexplode(_spans(history)).alias("number", "one")
    ).select("conv_id", (F.col("block") * SPANS_IN_BLOCK + F.col("number")).alias("window"), "head", "one.span", "one.past")
    repeat_head = F.col("head").isNotNull() & ~F.col("span")[0]["is_head"]
    head = F.when(repeat_head, F.array(F.struct(F.col("head")["role"].alias("role"), F.col("head")["text"].alias("text"))))
    shown = lambda c: F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    none = F.array().cast("array<struct<role:string,text:string>>")
    spans = spans.withColumn("repeated", F.concat(
        F.coalesce(head, none), F.coalesce(shown(F.sort_array(F.coalesce("past", F.array()))), none)
    ))
    parts = spans.select(
        "conv_id", "window", F.size("repeated").alias("n_repeated"),
        F.array_join(F.transform("repeated", _written), "").alias("lead"),
        F.transform("span", lambda t: F.struct(
            _written(t).alias("written"), (t["role"] == "assistant").alias("target"),
            F.char_length(escaped(t["role"])).alias("role_chars"), F.char_length(escaped(t["text"])).alias("text_chars"),
        )).alias("span"),
    )
    start = F.struct(F.char_length("lead").alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))
    loss = F.aggregate("span", start, lambda s, t: F.struct(
        (s["at"] + F.char_length(t["written"])).alias("at"),
        F.when(t["target"], F.array_append(s["loss"], F.struct(
            (s["at"] + t["role_chars"] + 8).alias("start"), t["text_chars"].alias("length")
        ))).otherwise(s["loss"]).alias("loss"),
    ), lambda s: s["loss"])
    return parts.select(
        "conv_id", "window",
        F.concat("lead", F.array_join(F.transform("span", lambda t: t["written"]), "")).alias("formatted"),
        "n_repeated", loss.alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and targets of each conversation as its windows hold them: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    marked = F.split("formatted", "</turn>\n")
    own = F.slice(marked, F.col("n_repeated") + 1, F.size(marked) - 1 - F.col("n_repeated"))
    role = lambda t: unescaped(F.substr(F.substring_index(t, ">", 1), F.lit(7)))
    text = lambda t: unescaped(F.substr(t, F.instr(t, ">") + 1))
    read = formatted.select(
        "conv_id", "window", F.size(own).alias("n"), F.char_length("formatted").alias("chars"),
        F.array_join(F.transform(own, lambda t: F.concat(role(t), F.lit("\n"), text(t), F.lit("\n"))), "").alias("turns"),
        F.array_join(F.transform("loss", lambda x: unescaped(F.substr("formatted", x["start"], x["length"]))), "").alias("target"),
    )
    joined = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("window", "turns", "target"))).alias("w"),
    )
    target = F.array_join(F.transform("w", lambda x: x["target"]), "")
    return joined.select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("w", lambda x: x["turns"]), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(target).cast("long").alias("loss_chars"), F.sha2(target.cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL = r"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id) AS c,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         length(text) + 4 * (length(text) - length(replace(text, '&', '')))
            + 3 * (length(text) - length(replace(replace(text, '<', ''), '>', ''))) AS text_chars,
         15 + length(role) + 4 * (length(role) - length(replace(role, '&', '')))
            + 3 * (length(role) - length(replace(replace(role, '<', ''), '>', ''))) AS other_chars
  FROM source
),
turns AS (
  SELECT *, CAST(ceil(text_chars / 4.0) AS BIGINT) + 8 AS tokens, text_chars + other_chars AS chars FROM numbered
),
heads AS (
  SELECT *, pos = 1 AND role = 'system' AS is_head,
         max(CASE WHEN pos = 1 AND role = 'system' THEN tokens END) OVER (PARTITION BY c) AS head_tokens,
         max(CASE WHEN pos = 1 AND role = 'system' THEN chars END) OVER (PARTITION BY c) AS head_chars
  FROM turns
),
placed AS (
  SELECT *, CASE WHEN is_head THEN 0 ELSE tokens END AS counted,
         sum(CASE WHEN is_head THEN 0 ELSE tokens END) OVER (PARTITION BY c ORDER BY pos)
            - CASE WHEN is_head THEN 0 ELSE tokens END AS begin_at,
         greatest(1, 1024 - 128 - coalesce(head_tokens, 0)) AS room
  FROM heads
),
dealt AS (
  SELECT *, begin_at // (16 * room) AS block,
         coalesce(sum(chars) OVER (PARTITION BY c, is_head ORDER BY begin_at RANGE BETWEEN 128 PRECEDING AND 1 PRECEDING), 0) AS past
  FROM placed
),
indexed AS (SELECT *, row_number() OVER (PARTITION BY c, block ORDER BY pos) AS i FROM dealt),
walk AS (
  SELECT c, block, i, pos, begin_at AS span FROM indexed WHERE i = 1
  UNION ALL
  SELECT t.c, t.block, t.i, t.pos,
         CASE WHEN t.begin_at > w.span AND t.begin_at + t.counted - w.span > t.room THEN t.begin_at ELSE w.span END
  FROM walk w JOIN indexed t ON t.c = w.c AND t.block = w.block AND t.i = w.i + 1
),
lengths AS (
  SELECT any_value(conv_id) AS conv_id, sum(chars) + arg_min(CASE WHEN is_head THEN 0 ELSE past END, pos)
         + CASE WHEN bool_or(is_head) THEN 0 ELSE coalesce(any_value(head_chars), 0) END AS chars
  FROM indexed JOIN walk USING (c, block, i, pos) GROUP BY c, block, span
),
whole AS (SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM lengths GROUP BY conv_id)
SELECT t.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       any_value(w.formatted_chars) AS formatted_chars
FROM turns t JOIN whole w USING (conv_id) GROUP BY t.conv_id
"""
