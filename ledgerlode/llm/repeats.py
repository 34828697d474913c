"""Removing what repeats from a smaller document: windows travel in segments to where their anchor is resolved.

A window is ``WINDOW`` consecutive units (words or bytes) of one document. Each window has an anchor, which its own
content alone determines, so equal windows have equal anchors at equal places. Consecutive windows with the
same anchor are one segment. First only short digests of the anchors' names are dealt out, to learn which names stand in
several documents. The segments under those are then dealt out by anchor with their content; where they meet, the
windows of different segments are compared, and ranges of units to remove go back to their documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlode.llm import arrays as A

WINDOW = 50
_PART_BYTES = 8 << 20
_WINDOWS = 100_000


@dataclass
class Segments:
    """One entry per segment: the row it is in, its first window's unit, how many windows, where the anchor lies from
    the first window on, the anchor's name and its place in the order of the parts, a digest of the content,
    and the bytes from the first window's start to the last one's end."""

    row: np.ndarray
    first: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    name: np.ndarray
    order: np.ndarray
    digest: np.ndarray
    byte_start: np.ndarray
    byte_end: np.ndarray


def same_anchor(start: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut windows at ``start`` into runs with one anchor: indices of the first windows, and the counts."""
    fresh = np.ones(len(start), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(fresh)
    return first, np.diff(np.append(first, len(start)))


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minima over the ranges [low, high), none of them empty, by doubling."""
    size = high - low
    out = np.empty(len(low), values.dtype)
    level, width = values, 1
    while len(size):
        now = (size >= width) & (size < 2 * width)
        if now.any():
            out[now] = np.minimum(level[low[now]], level[high[now] - width])
        if not (size >= 2 * width).any():
            break
        level = np.minimum(level[:-width], level[width:])
        width *= 2
    return out


Cut = Callable[[np.ndarray, np.ndarray], Segments]


_LOW = np.uint64(0xFFFFFFFF)


def _code(name: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The part that a name is counted in, and 32 more bits of it."""
    return ((name >> np.uint64(32)) % np.uint64(parts)).astype(np.int64), (name & _LOW).astype(np.uint32)


def _cut_all(cut: Cut, data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> Segments:
    found = []
    for a, b in A.slices(data, offsets[lo:hi + 1], 1 << 20):
        a, b = a + lo, b + lo
        s = cut(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        s.row = s.row + a
        s.byte_start, s.byte_end = s.byte_start + offsets[a], s.byte_end + offsets[a]
        found.append(s)
    return Segments(*[np.concatenate([getattr(f, n) for f in found]) for n in Segments.__dataclass_fields__])


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    return A.slices(data, offsets, 6 << 20)


def _announce(cut: Cut, parts: int):
    """The names that each document has, one packed value per part. Of a name that several documents of a batch have,
    one entry goes on, marked; that it is shared is known here."""
    def work(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        ids, marks = batch.column("doc_id").to_numpy(), batch.column("mark").to_numpy()
        data, offsets = A.text_bytes(batch.column("text"))
        out = []
        for lo, hi in _pieces(data, offsets):
            s = _cut_all(cut, data, offsets, lo, hi)
            if not len(s.row):
                continue
            part, code = _code(s.name, parts)
            key = part << 32 | code.astype(np.int64)
            order = np.lexsort((s.row, key))
            key, row = key[order], s.row[order]
            one = np.ones(len(key), bool)
            one[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
            key, row = key[one], row[one]
            fresh = np.ones(len(key), bool)
            fresh[1:] = key[1:] != key[:-1]
            first = np.flatnonzero(fresh)
            doc = ids[row]
            many = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
            shared = many[np.cumsum(fresh) - 1]
            goes = ~shared | fresh
            part, blobs = [], []
            at = (key >> 32)[goes]
            edge = np.flatnonzero(np.diff(at, prepend=-1))
            for p, a, b in zip(at[edge].tolist(), edge.tolist(), [*edge[1:].tolist(), len(at)], strict=True):
                part.append(p)
                rows, local = np.unique(row[goes][a:b], return_inverse=True)
                by_row = np.argsort(local, kind="stable")
                blobs.append(A.pack(ids[rows], marks[rows], np.bincount(local, minlength=len(rows)).astype(np.int32),
                                    (key[goes][a:b] & 0xFFFFFFFF).astype(np.uint32)[by_row],
                                    shared[goes][a:b][by_row], np.zeros(0, np.int64), np.zeros(0, np.int32),
                                    np.zeros(0, np.int64)))
            if shared.any():
                rows, local = np.unique(row[shared], return_inverse=True)
                by_row = np.argsort(local, kind="stable")
                part.append(int(ids[lo] % parts))
                blobs.append(A.pack(ids[rows], marks[rows], np.zeros(len(rows), np.int32), np.zeros(0, np.uint32),
                                    np.zeros(0, bool), np.zeros(0, np.int64),
                                    np.bincount(local, minlength=len(rows)).astype(np.int32), key[shared][by_row]))
            out.append(A.batch_of(part=np.array(part, np.int32), block=pa.array(blobs, pa.binary())))
        return out
    return A.by_batch(work)


_NAMES = (np.int64, np.int64, np.int32, np.uint32, bool, np.int64, np.int32, np.int64)


def _shared_names(buckets: int):
    """Which names several documents have, back to each of these: packed numbers of part and code."""
    def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = int(key[0].as_py())
        read = [A.unpack(blob, *_NAMES) for blob in table.column("block").to_pylist()]
        doc, mark = (np.concatenate([np.repeat(b[i], b[2]) for b in read]) for i in (0, 1))
        code, known = (np.concatenate([b[i] for b in read]) for i in (3, 4))
        order = np.lexsort((doc, code))
        doc, mark, code, known = doc[order], mark[order], code[order], known[order]
        found = [(np.concatenate([np.repeat(b[i], b[6]) for b in read if len(b[6])] or [np.zeros(0, np.int64)]))
                 for i in (0, 1)]
        keys = [np.concatenate([b[7] for b in read])]
        if len(code):
            fresh = np.ones(len(code), bool)
            fresh[1:] = code[1:] != code[:-1]
            first = np.flatnonzero(fresh)
            several = ((np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first))
                       | np.logical_or.reduceat(known, first))[np.cumsum(fresh) - 1] & ~known
            found = [np.concatenate((found[0], doc[several])), np.concatenate((found[1], mark[several]))]
            keys.append(code[several].astype(np.int64) | part << 32)
        return _sent_back(buckets, *found, np.concatenate(keys))
    return work


def _sent_back(buckets: int, doc: np.ndarray, mark: np.ndarray, *values: np.ndarray) -> pa.Table:
    """Values for documents, one packed value per bucket of documents."""
    bucket = (A.mix(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((*values[::-1], mark, doc, bucket))
    edge = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    blobs = []
    for a, b in zip(edge.tolist(), np.append(edge[1:], len(order)).tolist()):
        mine = order[a:b]
        blobs.append(A.pack(doc[mine], mark[mine], *[np.diff(v[mine], prepend=0) for v in values]))
    return pa.table({"bucket": bucket[order][edge].astype(np.int32), "block": pa.array(blobs, pa.binary())})


def _by_document(width: int):
    """One row per document out of a bucket of them, with its values side by side in one packed value."""
    def work(table: pa.Table) -> pa.Table:
        read = [A.unpack(blob, *[np.int64] * (2 + width)) for blob in table.column("block").to_pylist()]
        doc, mark = (np.concatenate([b[i] for b in read]) for i in (0, 1))
        values = np.stack([np.concatenate([np.cumsum(b[2 + k]) for b in read]) for k in range(width)], axis=1)
        order = np.lexsort((mark, doc))
        doc, mark, values = doc[order], mark[order], values[order]
        edge = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]))))
        blobs = [values[a:b].tobytes() for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(doc)], strict=True)]
        return pa.table({"doc_id": doc[edge], "mark": mark[edge], "found": pa.array(blobs, pa.binary())})
    return work


def _deal(cut: Cut, splitters: np.ndarray, parts: int):
    """The segments of a batch under shared names, one packed value per part. Where segments of a batch are equal, only
    those of the smallest document go on; the others are known to be repeats."""
    def work(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        names = batch.column("names")
        batch = batch.filter(names.is_valid())
        ids, marks = batch.column("doc_id").to_numpy(), batch.column("mark").to_numpy()
        names = batch.column("names").to_pylist()
        data, offsets = A.text_bytes(batch.column("text"))
        out = []
        for lo, hi in _pieces(data, offsets):
            s = _cut_all(cut, data, offsets, lo, hi)
            part, code = _code(s.name, parts)
            shared = np.zeros(len(part), bool)
            key = part << 32 | code.astype(np.int64)
            edge = np.searchsorted(s.row, np.arange(lo, hi + 1))
            for i in range(lo, hi):
                mine = slice(edge[i - lo], edge[i - lo + 1])
                shared[mine] = np.isin(key[mine], np.frombuffer(names[i], np.int64))
            s = Segments(*[getattr(s, n)[shared] for n in Segments.__dataclass_fields__])
            if len(s.row):
                out.append(_dealt(s, ids, marks, data, splitters, int(ids[lo] % (len(splitters) + 1))))
        return out
    return A.by_batch(work)


def _dealt(s: Segments, ids, marks, data, splitters, own_part: int) -> pa.RecordBatch:
    part = np.searchsorted(splitters, s.order, "right")
    doc = ids[s.row]
    order = np.lexsort((doc, s.digest, s.name, part))
    name, digest = s.name[order], s.digest[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (name[1:] != name[:-1]) | (digest[1:] != digest[:-1])
    goes = doc[order] == doc[order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    known, order = order[~goes], order[goes]
    out_part, out = [], []
    edge = np.flatnonzero(np.diff(part[order], prepend=-1))
    nothing = np.zeros(0, np.int64)
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(order)], strict=True):
        mine = order[a:b]
        rows, local = np.unique(s.row[mine], return_inverse=True)
        length = s.byte_end[mine] - s.byte_start[mine]
        out_part.append(int(part[mine[0]]))
        out.append(A.pack(ids[rows], marks[rows], nothing.astype(np.int32), nothing, nothing, local.astype(np.int32),
                          s.first[mine], s.count[mine].astype(np.int16), s.anchor[mine].astype(np.int16),
                          s.name[mine], length.astype(np.int32), data[A.ranges(s.byte_start[mine], length)], level=9))
    if len(known):
        rows, local = np.unique(s.row[known], return_inverse=True)
        out_part.append(own_part)
        out.append(A.pack(ids[rows], marks[rows], local.astype(np.int32), s.first[known],
                          s.first[known] + s.count[known] - 1 + WINDOW, *[nothing.astype(k) for k in _KINDS[5:]]))
    return A.batch_of(part=np.array(out_part, np.int32), block=pa.array(out, pa.binary()))


_KINDS = (np.int64, np.int64, np.int32, np.int64, np.int64, np.int32, np.int64, np.int16, np.int16, np.uint64,
          np.int32, np.uint8)

#: From the content of segments, and windows given by segment and unit, to an order of the windows within the same
#: group, and whether each one in that order differs from the one before.
Compare = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _chunks(group: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of entries of about a hundred thousand windows that do not part a group."""
    edge = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
    total = np.concatenate(([0], np.cumsum(count)))
    at = 0
    while at < len(edge) - 1:
        to = int(np.searchsorted(total[edge], total[edge[at]] + _WINDOWS, "right")) - 1
        to = min(max(to, at + 1), len(edge) - 1)
        yield int(edge[at]), int(edge[to])
        at = to


def _resolve(compare: Compare, buckets: int):
    """Ranges to remove, out of all segments of a part."""
    def work(table: pa.Table) -> pa.Table:
        read = [A.unpack(blob, *_KINDS) for blob in table.column("block").to_pylist()]
        span = [np.concatenate([b[i][b[k]] for b in read]) for i, k in ((0, 2), (1, 2))]
        spans = [(span[0], span[1], np.concatenate([b[3] for b in read]), np.concatenate([b[4] for b in read]))]
        doc, mark = (np.concatenate([b[i][b[5]] for b in read]) for i in (0, 1))
        first, count, anchor, name, length, content = (np.concatenate([b[i] for b in read]) for i in range(6, 12))
        digest = np.concatenate([A.byte_digests(b[11], (end := np.cumsum(b[10], dtype=np.int64)) - b[10], end)
                                 for b in read])
        del read
        at = np.cumsum(length.astype(np.int64)) - length
        order = np.lexsort((mark, doc, digest, name))
        doc, mark, first, count, anchor = doc[order], mark[order], first[order], count[order].astype(np.int64), anchor[order]
        name, digest, at, length = name[order], digest[order], at[order], length[order].astype(np.int64)
        new_name = np.ones(len(doc), bool)
        new_name[1:] = name[1:] != name[:-1]
        fresh = new_name.copy()
        fresh[1:] |= digest[1:] != digest[:-1]
        lead = np.flatnonzero(fresh)
        kind = np.cumsum(fresh) - 1
        least = doc[lead]
        # Segments with a smaller document's content are repeats as a whole.
        later = doc > least[kind]
        spans.append((doc[later], mark[later], first[later], first[later] + count[later] - 1 + WINDOW))
        # Windows of different contents are compared where an anchor has several, of different documents.
        group = np.cumsum(new_name[lead]) - 1
        if len(lead):
            edge = np.flatnonzero(new_name[lead])
            apart = np.minimum.reduceat(least, edge) < np.maximum.reduceat(least, edge)
            chosen = np.flatnonzero(apart[group])
        else:
            chosen = lead
        run_kind, run_from, run_to = [], [], []
        for a, b in _chunks(group[chosen], count[lead[chosen]]):
            mine = chosen[a:b]
            rows = lead[mine]
            size = length[rows]
            held = content[A.ranges(at[rows], size)]
            entry = np.repeat(np.arange(len(rows)), count[rows])
            unit = A.ranges(np.zeros(len(rows), np.int64), count[rows])
            place = anchor[rows][entry] - unit
            together = np.unique(group[mine][entry] * (2 * WINDOW) + place, return_inverse=True)[1]
            sequence, differs = compare(held, np.concatenate(([0], np.cumsum(size))), entry, unit, together)
            edge = np.flatnonzero(differs)
            smallest = np.minimum.reduceat(least[mine][entry[sequence]], edge)[np.cumsum(differs) - 1]
            repeat = np.zeros(len(entry), bool)
            repeat[sequence] = smallest < least[mine][entry[sequence]]
            # Runs of repeated windows within a segment.
            on = np.flatnonzero(repeat & ~(np.concatenate(([False], repeat[:-1])) & (unit > 0)))
            off = np.flatnonzero(repeat & ~np.concatenate(
                (repeat[1:] & (unit[1:] > 0), [False])))
            run_kind.append(mine[entry[on]])
            run_from.append(unit[on])
            run_to.append(unit[off] + WINDOW)
        if run_kind:
            of, start, end = np.concatenate(run_kind), np.concatenate(run_from), np.concatenate(run_to)
            # All places where the smallest document has that content.
            own = np.bincount(kind[~later], minlength=len(lead))[of]
            rows = A.ranges(lead[of], own)
            spans.append((doc[rows], mark[rows], first[rows] + np.repeat(start, own), first[rows] + np.repeat(end, own)))
        doc, mark, start, end = (np.concatenate([s[i] for s in spans]) for i in range(4))
        return _sent_back(buckets, doc, mark, start, end)
    return work


def part_count(documents: DataFrame) -> tuple[int, int]:
    """Parts of about 8 MB of text, twice the shuffle partitions at least; and as many buckets of documents, by the
    size alone, so that more partitions do not cut what goes back into smaller values."""
    size = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shuffles = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * shuffles, int(size) // _PART_BYTES), max(24, int(size) // _PART_BYTES)


def repeated_spans(documents: DataFrame, cut: Cut, compare: Compare, splitters: np.ndarray,
                   buckets: int) -> DataFrame:
    """``doc_id, text, spans`` for each document; ``spans`` are packed ranges of units to remove, or null.

    Rows with one id and different texts keep apart by a hash of the text.
    """
    parts = len(splitters) + 1
    ids = ["doc_id", "mark"]
    marked = documents.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    block = "bucket int, block binary"
    documents_of = "doc_id long, mark long, found binary"
    names = (marked.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= WINDOW))
                   .mapInArrow(_announce(cut, parts), "part int, block binary")
                   .groupBy("part").applyInArrow(_shared_names(buckets), block)
                   .groupBy("bucket").applyInArrow(_by_document(1), documents_of).withColumnRenamed("found", "names"))
    # Both joins deal the texts out in the same way, so Spark does it once.
    spans = (marked.join(names, ids, "left")
                   .mapInArrow(_deal(cut, splitters, parts), "part int, block binary")
                   .groupBy("part").applyInArrow(_resolve(compare, buckets), block)
                   .groupBy("bucket").applyInArrow(_by_document(2), documents_of).withColumnRenamed("found", "spans"))
    return marked.join(spans, ids, "left").select("doc_id", "text", "spans")


def removed(spans: bytes | None, n: int) -> np.ndarray:
    """Which of n units the spans cover."""
    if not spans:
        return np.zeros(n, bool)
    pairs = np.frombuffer(spans, np.int64).reshape(-1, 2)
    return A.cover(pairs[:, 0], pairs[:, 1], n)
