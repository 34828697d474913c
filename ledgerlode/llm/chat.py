"""Chat formatting by prefix-target expansion: DataFrame functions, and digests of a conversation turn by turn."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlode.sources.files import stored

# What the template puts before and after a turn's text.
TEMPLATE = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("[SYS] ", " [/SYS]")}
OTHER = ("[ROLE:", "] ", " [/ROLE]")
_CONTROL = r"(/?s>|/?INST\]|/?SYS\]|ROLE:|/ROLE\])"
_ESCAPE = r"([<\[])(\\*)" + _CONTROL
_UNESCAPE = r"([<\[])\\(\\*)" + _CONTROL


def escape(text: Column) -> Column:
    """One backslash more inside whatever reads as a control string, so that none is left in the text."""
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def _segment(role: Column, text: Column) -> Column:
    code = F.hex(F.encode(role, "UTF-8"))
    out = F.concat(F.lit(OTHER[0]), code, F.lit(OTHER[1]), text, F.lit(OTHER[2]))
    for name, (before, after) in TEMPLATE.items():
        out = F.when(role == name, F.concat(F.lit(before), text, F.lit(after))).otherwise(out)
    return out


#: So many characters of a text take part in cutting the turns into ranges.
_CUT = 32


def format_turns(conversations: DataFrame) -> DataFrame:
    """The rendered corpus, one segment per turn: ``conv_id, position, turn, segment, offset, chars,
    mask_start, mask_end``.

    The segments of a conversation in the order of ``position`` are its text; ``offset`` is where a segment
    starts in it, and the mask is the assistant's reply within the segment (empty for other roles), all in code
    points. Turns follow each other by turn (null last), then role, then text, so repeated turns have a
    place too. A null text or role is empty. Null conversation ids are one conversation. Ids and turns may be any
    long. Other columns are ignored; an empty table gives no rows.

    One shuffle deals the turns into ranges of that order, so a conversation of any length is cut like all else;
    each range numbers its turns, is stored, and one row of it tells what its last conversation has so far. Equal
    turns stay in one range.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    escaped = escape(text)
    reply = F.when(role == "assistant", F.length(escaped))
    start = F.length(F.lit(TEMPLATE["assistant"][0]))
    turns = conversations.select(
        "conv_id", "turn", role.alias("__role"), text.alias("__text"), _segment(role, escaped).alias("segment"),
        F.when(reply.isNotNull(), start).otherwise(F.lit(0)).cast("long").alias("mask_start"),
        F.coalesce(start + reply, F.lit(0)).cast("long").alias("mask_end"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("__role")]
    ranges = (turns.withColumn("chars", F.length("segment").cast("long"))
                   .repartitionByRange(*order, F.substring("__text", 1, _CUT))
                   .sortWithinPartitions(*order, "__text").withColumn("__range", F.spark_partition_id())
                   .drop("__role", "__text"))
    schema = T.StructType([*ranges.schema.fields, *[T.StructField(n, T.LongType()) for n in ("__row", "__place", "__begin")]])
    numbered = stored(ranges.mapInArrow(_number, schema), "chat-turns", None, "zstd")
    carried = F.broadcast(_carries(numbered))                        # at most one row per range
    before = numbered.join(carried, (F.col("__range") == F.col("__of")) & F.col("conv_id").eqNullSafe(F.col("__conv")),
                           "left")
    return before.select(
        "conv_id", (F.col("__place") + F.coalesce("__turns", F.lit(0))).alias("position"), "turn", "segment",
        (F.col("__begin") + F.coalesce("__chars", F.lit(0))).alias("offset"), "chars", "mask_start", "mask_end")


def _number(batches):
    """Number the sorted rows of a range, and count turns and characters of each conversation before them."""
    row, now, turns, chars = 0, None, 0, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column("conv_id")
        ids, null = conv.fill_null(0).to_numpy(zero_copy_only=False), conv.is_null().to_numpy(zero_copy_only=False)
        size = batch.column("chars").to_numpy()
        fresh = np.ones(n, bool)
        fresh[1:] = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
        first = (ids[0], null[0])
        fresh[0] = now != first
        head = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
        total = np.concatenate(([0], np.cumsum(size)))
        place = np.where(head < 0, turns + np.arange(n), np.arange(n) - head)
        begin = np.where(head < 0, chars + total[:-1], total[:-1] - total[np.maximum(head, 0)])
        now, turns, chars = (ids[-1], null[-1]), int(place[-1]) + 1, int(begin[-1] + size[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(row + np.arange(n)), pa.array(place), pa.array(begin)],
                                         [*batch.schema.names, "__row", "__place", "__begin"])
        row += n


def _carries(numbered: DataFrame) -> DataFrame:
    """What the first conversation of each range has in the ranges before: ``__of, __conv, __turns, __chars``."""
    kind = numbered.schema["conv_id"].dataType
    last = F.struct("conv_id", (F.col("__place") + 1).alias("turns"), (F.col("__begin") + F.col("chars")).alias("chars"))
    ends = numbered.groupBy("__range").agg(F.min_by(F.struct("conv_id"), "__row").alias("first"),
                                           F.max_by(last, "__row").alias("last")).orderBy("__range").collect()
    out, open_ = [], None
    for r in ends:                                                   # one row per range
        turns, chars = r.last.turns, r.last.chars
        if open_ is not None and open_[0] == r.first.conv_id:
            out.append((r["__range"], r.first.conv_id, open_[1], open_[2]))
            if r.last.conv_id == r.first.conv_id:
                turns, chars = turns + open_[1], chars + open_[2]
        open_ = (r.last.conv_id, turns, chars)
    schema = T.StructType([T.StructField("__of", T.IntegerType()), T.StructField("__conv", kind),
                           T.StructField("__turns", T.LongType()), T.StructField("__chars", T.LongType())])
    return numbered.sparkSession.createDataFrame(out, schema)


#: Where set, a conversation's text beyond so many characters is not repeated in its later examples, which name it by its
#: length (``shared_chars``). Unset, every example holds its whole context.
CONTEXT_CHARS: int | None = None
#: So many characters of a conversation make a block, whose examples are written together.
BLOCK_CHARS = 1 << 16
#: So many conversations of several blocks are told to every task; more are joined by a shuffle.
_FEW = 50_000
_BATCH_CHARS = 4 << 20


def expand(turns: DataFrame) -> DataFrame:
    """The training examples: one per assistant turn, ``conv_id, target, shared_chars, text, context_chars,
    target_chars, mask_start, mask_end``.

    An example is the conversation's rendering up to the end of its target turn, with only that reply trainable;
    ``context_chars`` and the mask count from its start. ``text`` holds all of it, so ``shared_chars`` is 0.

    Examples grow with the square of a conversation's turns. So a long conversation is cut into blocks of
    ``BLOCK_CHARS``: each block with replies gets the turns before it and is written by itself, and only these copies of
    turns are shuffled, never the texts of the examples. A task holds one conversation up to its block, as its
    examples do.
    """
    block = F.floor(F.col("offset") / BLOCK_CHARS)
    rows = turns.select("conv_id", "position", "segment", "offset", "chars", "mask_start", "mask_end",
                        block.alias("__block"))
    long_ = stored(rows.where("mask_end > 0").groupBy("conv_id").agg(F.collect_set("__block").alias("__blocks"))
                       .where(F.array_max("__blocks") > 0).withColumnRenamed("conv_id", "__conv"), "chat-blocks")
    n = long_.count()
    if n:
        after = F.filter("__blocks", lambda b: b >= F.col("__block"))
        rows = (rows.join(F.broadcast(long_) if n <= _FEW else long_.hint("merge"),
                          F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
                    .withColumn("__at", F.explode(F.coalesce(after, F.array("__block")))))
    else:
        rows = rows.withColumn("__at", F.col("__block"))
    own = F.col("__at") == F.col("__block")
    dealt = rows.repartition("conv_id", "__at").sortWithinPartitions("conv_id", "__at", "position")
    return dealt.select("conv_id", "position", "segment", "offset", "chars", "mask_start",
                        F.when(own, F.col("mask_end")).otherwise(F.lit(0)).alias("mask_end")).mapInArrow(
        _expand, T.StructType([
            T.StructField("conv_id", turns.schema["conv_id"].dataType), T.StructField("target", T.LongType()),
            T.StructField("shared_chars", T.LongType()), T.StructField("text", T.StringType()),
            *[T.StructField(n, T.LongType()) for n in ("context_chars", "target_chars", "mask_start", "mask_end")]]))


def _expand(batches):
    """One example per reply, with the turns of its conversation that were read before it. A turn that has no mask is
    context alone."""
    said, held, shared, last = [], 0, 0, None
    for batch in batches:
        out, size = [], 0
        kind = batch.schema.field("conv_id").type
        for conv, place, segment, offset, chars, start, end in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if last != (conv, place - 1) or (CONTEXT_CHARS is not None and held > CONTEXT_CHARS):
                said, held, shared = [], 0, offset
            said.append(segment)
            held, last = held + chars, (conv, place)
            if end > 0:
                said = ["".join(said)]
                out.append((conv, place, shared, said[0], offset, chars, offset + start, offset + end))
                size += held
            if size > _BATCH_CHARS:
                yield _examples(out, kind)
                out, size = [], 0
        if out:
            yield _examples(out, kind)


def _examples(rows: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
    kinds = [conv, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["conv_id", "target", "shared_chars", "text", "context_chars", "target_chars", "mask_start", "mask_end"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def example_texts(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """The examples with their whole texts. The output holds each prefix again and grows with the square of a
    conversation's turns; where that is too much, read ``turns`` and ``examples`` as they are."""
    whole = (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("position", "segment"))).alias("__all"))
                  .select(F.col("conv_id").alias("__conv"), F.array_join(F.col("__all.segment"), "").alias("__said")))
    return (examples.join(whole, F.col("conv_id").eqNullSafe(F.col("__conv")))
                    .withColumn("text", F.concat(F.substring("__said", F.lit(1), F.col("shared_chars").cast("int")), "text"))
                    .drop("__conv", "__said", "shared_chars"))


def read_turns(turns: DataFrame, *carry: str) -> DataFrame:
    """Role and text of each turn out of the rendered segments: ``conv_id, position, role, text`` and the columns
    ``carry``."""
    segment = F.col("segment")

    def inner(before: int, after: int) -> Column:
        return F.substring(segment, F.lit(before + 1), F.length(segment) - F.lit(before + after))

    code_end = F.locate(OTHER[1], segment)
    code = F.substring(segment, F.lit(len(OTHER[0]) + 1), code_end - F.lit(len(OTHER[0]) + 1))
    role = F.decode(F.unhex(code), "UTF-8")
    text = F.substring(segment, code_end + F.lit(len(OTHER[1])),
                       F.length(segment) - code_end - F.lit(len(OTHER[1]) + len(OTHER[2]) - 1))
    for name, (before, after) in TEMPLATE.items():
        here = segment.startswith(before)
        role = F.when(here, F.lit(name)).otherwise(role)
        text = F.when(here, inner(len(before), len(after))).otherwise(text)
    return turns.select("conv_id", "position", role.alias("role"), unescape(text).alias("text"), *carry)


def read_segment(segment: str) -> tuple[str, str]:
    """Role and text of one rendered turn, as ``read_turns`` gives them."""
    for name, (before, after) in TEMPLATE.items():
        if segment.startswith(before):
            return name, re.sub(_UNESCAPE, r"\1\2\3", segment[len(before):len(segment) - len(after)])
    code, text = segment[len(OTHER[0]):len(segment) - len(OTHER[2])].split(OTHER[1], 1)
    return bytes.fromhex(code).decode(), re.sub(_UNESCAPE, r"\1\2\3", text)


def digest(turns: DataFrame, examples: DataFrame | None = None) -> DataFrame:
    """What the output holds, per conversation: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``. The last is the length of all examples and, once, of the turns after the last reply.

    Roles and texts are read back from the turns' segments; replies are cut out of the texts of ``examples``
    (``expand(turns)`` where none are given) by their masks, and lengths are those of these texts with what they share.
    Both meet sorted by conversation and position. A conversation's digest takes its turns one by one, never as one
    value."""
    known = expand(turns) if examples is None else examples
    reply = F.substring(F.col("text"), (F.col("mask_start") - F.col("shared_chars") + 1).cast("int"),
                        (F.col("mask_end") - F.col("mask_start")).cast("int"))
    length = F.least(F.col("shared_chars") + F.length("text"), F.col("context_chars") + F.col("target_chars"))
    rows = turns.select("conv_id", "position", "segment", F.lit(None).cast("string").alias("reply"),
                        F.lit(None).cast("long").alias("length")).unionByName(known.select(
        "conv_id", F.col("target").alias("position"), F.lit(None).cast("string").alias("segment"), reply.alias("reply"),
        length.alias("length")))
    schema = T.StructType([T.StructField(n, k) for n, k in (
        ("conv_id", T.LongType()), ("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()),
        ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType()))])
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "position", F.col("segment").isNull())
                .mapInArrow(_read_back, schema))


class _Read:
    """The state of reading one conversation."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.said, self.loss = conv, 0, hashlib.sha256(), hashlib.sha256()
        self.chars = self.after_reply = self.loss_chars = self.formatted = 0

    def turn(self, segment: str) -> None:
        role, text = read_segment(segment)
        self.said.update(f"{role}\n{text}\n".encode())
        self.turns += 1
        self.chars += len(segment)

    def example(self, reply: str, length: int) -> None:
        reply = re.sub(_UNESCAPE, r"\1\2\3", reply)
        self.loss.update(reply.encode())
        self.loss_chars += len(reply)
        self.formatted += length
        self.after_reply = self.chars

    def row(self) -> tuple:
        return (self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.formatted + self.chars - self.after_reply)


def _read_back(batches):
    """One row per run of rows with one conv_id; only the running state is held."""
    state = None
    for batch in batches:
        out = []
        for conv, _, segment, reply, length in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if state is None or conv != state.conv:
                if state is not None:
                    out.append(state.row())
                state = _Read(conv)
            if segment is not None:
                state.turn(segment)
            else:
                state.example(reply, length)
        if out:
            yield _digests(out)
    if state is not None:
        yield _digests([state.row()])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


CHAT_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|ROLE:|/ROLE\])', '\1\\\2\3', 'g'))
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 WHEN 'system' THEN 13 ELSE 16 + 2 * strlen(role) END AS chars
  FROM rows_),
ended AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ending FROM sized)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (coalesce(sum(ending) FILTER (role = 'assistant'), 0) + max(ending)
        - coalesce(max(ending) FILTER (role = 'assistant'), 0))::BIGINT AS formatted_chars
FROM ended GROUP BY conv_id
"""
