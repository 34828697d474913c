"""Benchmark decontamination by Wu-Manber search over words."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlode.llm import arrays as A
from ledgerlode.sources.files import stored

WINDOW = 10
#: Words of benchmark text that one scan searches for; a larger benchmark takes several scans.
SCAN_WORDS = 400_000
_CHUNK = 128
#: Words are runs of digits, letters and bytes beyond ASCII, letters in lower case.
GAP = np.ones(256, bool)
GAP[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_WORD_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass
class Group:
    """The search tables for all patterns of one length."""

    length: int
    block: int
    shift: np.ndarray       # by the low bits of a block's digest: how far the window may move
    suffix: np.ndarray      # digests of last blocks, sorted; patterns lie in this order
    prefix: np.ndarray      # digests of first blocks
    first: np.ndarray       # where the pattern starts among the words of the benchmark
    items_from: np.ndarray  # the items of pattern p are items[items_from[p]:items_from[p + 1]]
    items: np.ndarray


@dataclass
class Tables:
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    ids: list[str | None]
    groups: list[Group]


def _words(column) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = A.text_bytes(column)
    return A.LOWER[data], offsets


def _blocks(words: np.ndarray, block: int) -> np.ndarray:
    """Digest of the ``block`` words that end at each position; positions too early hold nothing."""
    out = np.zeros(len(words), np.uint64)
    if len(words) >= block:
        at = np.arange(block, len(words) + 1)
        out[block - 1:] = A.sequence_digests(words, at - block, at)
    return out


def build_tables(items: pa.Table, window: int = WINDOW) -> Tables:
    """Shift tables and suffix buckets of the windows of ``item_id, text`` rows."""
    data, offsets = _words(items.column("text"))
    starts, ends, of_item = A.find_words(data, offsets, GAP)
    words = A.byte_digests(data, starts, ends)
    n = np.diff(of_item)
    windows = np.where(n == 0, 0, np.maximum(n - window + 1, 1))
    first = A.ranges(of_item[:-1], windows)
    owner = np.repeat(np.arange(len(n)), windows)
    length = np.minimum(n, window)[owner]
    groups = []
    for m in np.unique(length).tolist():
        at, item = first[length == m], owner[length == m]
        whole = A.sequence_digests(words, at, at + m)
        _, one, same = np.unique(whole, return_index=True, return_inverse=True)
        block = min(2, m)
        ending = _blocks(words, block)
        place = at[one]
        by_suffix = np.argsort(ending[place + m - 1], kind="stable")
        place = place[by_suffix]
        rank = np.empty(len(one), np.int64)
        rank[by_suffix] = np.arange(len(one))
        pairs = np.unique(np.stack([rank[same], item]), axis=1)
        size = 1 << max(12, int(4 * m * len(place)).bit_length())
        shift = np.full(size, m - block + 1, np.int64)
        for end in range(block, m + 1):
            np.minimum.at(shift, (ending[place + end - 1] & np.uint64(size - 1)).astype(np.int64), m - end)
        groups.append(Group(m, block, shift, ending[place + m - 1], ending[place + block - 1], place,
                            np.searchsorted(pairs[0], np.arange(len(place) + 1)), pairs[1]))
    ids = [None if i is None else str(i) for i in items.column("item_id").to_pylist()]
    return Tables(data, starts, ends, ids, groups)


def _ends_to_check(words: np.ndarray, of_doc: np.ndarray, group: Group) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a pattern may end: all chunks move on together, each by its own shift."""
    ending = _blocks(words, group.block)
    first, last = of_doc[:-1] + group.length - 1, of_doc[1:]
    chunks = np.maximum(0, -(-(last - first) // _CHUNK))
    at = np.repeat(first, chunks) + _CHUNK * A.ranges(np.zeros(len(chunks), np.int64), chunks)
    stop = np.minimum(at + _CHUNK, np.repeat(last, chunks))
    mask = np.uint64(len(group.shift) - 1)
    found = []
    while len(at):
        move = group.shift[(ending[at] & mask).astype(np.int64)]
        found.append(at[move == 0])
        at = at + np.maximum(move, 1)
        going = at < stop
        at, stop = at[going], stop[going]
    return (np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)), ending


def _occurrences(data, starts, ends, words, of_doc, tables: Tables, group: Group):
    """Word positions where patterns start, and the patterns, each compared byte by byte."""
    m = group.length
    at, ending = _ends_to_check(words, of_doc, group)
    low = np.searchsorted(group.suffix, ending[at], "left")
    count = np.searchsorted(group.suffix, ending[at], "right") - low
    pattern = A.ranges(low, count)
    begin = np.repeat(at, count) - m + 1
    fits = ending[begin + group.block - 1] == group.prefix[pattern]
    pattern, begin = pattern[fits], begin[fits]
    for k in range(m):
        here, there = begin + k, group.first[pattern] + k
        size = ends[here] - starts[here]
        same = size == tables.ends[there] - tables.starts[there]
        begin, pattern, here, there, size = begin[same], pattern[same], here[same], there[same], size[same]
        if not len(begin):
            break
        equal = data[A.ranges(starts[here], size)] == tables.data[A.ranges(tables.starts[there], size)]
        alike = np.logical_and.reduceat(equal, np.cumsum(size) - size)
        begin, pattern = begin[alike], pattern[alike]
    return begin, pattern


def _search(data: np.ndarray, offsets: np.ndarray, tables: Tables):
    """Per document the number of words, the hit flags of all words, and (document, item) pairs."""
    starts, ends, of_doc = A.find_words(data, offsets, GAP)
    words = A.byte_digests(data, starts, ends)
    spans, pairs = [], [np.zeros((2, 0), np.int64)]
    for group in tables.groups:
        begin, pattern = _occurrences(data, starts, ends, words, of_doc, tables, group)
        spans.append((begin, begin + group.length))
        count = group.items_from[pattern + 1] - group.items_from[pattern]
        item = group.items[A.ranges(group.items_from[pattern], count)]
        doc = np.searchsorted(of_doc, np.repeat(begin, count), "right") - 1
        pairs.append(np.unique(np.stack([doc, item]), axis=1))
    lo = np.concatenate([s[0] for s in spans] or [np.zeros(0, np.int64)])
    hi = np.concatenate([s[1] for s in spans] or [np.zeros(0, np.int64)])
    return of_doc, A.cover(lo, hi, len(starts)), np.concatenate(pairs, axis=1)


_STATE = "doc_id long, text string, spans array<array<long>>, items array<string>"
_RESULT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
           "items array<string>, spans array<array<long>>")


def _runs(flags: np.ndarray) -> list[list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edge.reshape(-1, 2).tolist()


def _scan(tables_in, last: bool):
    def work(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        tables = tables_in.value
        out = []
        data, offsets = _words(batch.column("text"))
        before_spans = batch.column("spans").to_pylist()
        before_items = batch.column("items").to_pylist()
        for lo, hi in A.slices(data, offsets):
            of_doc, hit, pairs = _search(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], tables)
            found: dict[int, set] = {}
            for doc, item in pairs.T.tolist():
                if tables.ids[item] is not None:
                    found.setdefault(doc, set()).add(tables.ids[item])
            n_words = np.diff(of_doc)
            n_hit = np.add.reduceat(np.append(hit, False).astype(np.int64), of_doc[:-1])
            n_hit[n_words == 0] = 0
            spans, items = [], []
            for i in range(hi - lo):
                flags = hit[of_doc[i]:of_doc[i + 1]] if n_hit[i] or before_spans[lo + i] else None
                if flags is not None and before_spans[lo + i]:
                    flags = flags.copy()
                    for a, b in before_spans[lo + i]:
                        flags[a:b] = True
                    n_hit[i] = flags.sum()
                spans.append(_runs(flags) if flags is not None else [])
                items.append(sorted(found.get(i, set()) | set(before_items[lo + i] or ())))
            columns = {"doc_id": batch.column("doc_id").slice(lo, hi - lo)}
            kinds = {"spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                     "items": pa.array(items, pa.list_(pa.string()))}
            if last:
                columns |= {"n_words": n_words, "n_hit": n_hit,
                            "n_items": np.array([len(x) for x in items], np.int64),
                            "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items],
                            "contaminated": n_hit > 0, "items": kinds["items"], "spans": kinds["spans"]}
            else:
                columns |= {"text": batch.column("text").slice(lo, hi - lo), **kinds}
            out.append(A.batch_of(**columns))
        return out
    return A.by_batch(work)


def _tables(benchmark: DataFrame, scan_words: int):
    """The search tables of the benchmark, cut into parts that hold about ``scan_words`` words."""
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", "text")
    words = items.agg(F.coalesce(F.sum(F.regexp_count(F.lower("text"), F.lit(_WORD_SQL))), F.lit(0))).first()[0]
    parts = max(1, -(-int(words) // scan_words))
    for part in range(parts):
        mine = items if parts == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield spark.sparkContext.broadcast(build_tables(mine.toArrow())), part == parts - 1


def find_contamination(documents: DataFrame, benchmark: DataFrame,
                       scan_words: int = SCAN_WORDS) -> DataFrame:
    """Words of each document that belong to an occurrence of a window of the benchmark.

    Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case. A window is ten
    consecutive words of an item, or all words of a shorter item. Returns ``doc_id, n_words, n_hit, n_items,
    items_sha256`` (of the item ids, sorted as text and joined by commas), ``contaminated``, ``items`` and the
    word ranges ``spans``.

    Wu-Manber: the digest of the last two words of the window in view tells how many words it may move on;
    where it may not move, the patterns with those last two words and the same first two are compared with
    the text byte by byte. Only the benchmark is sent to the tasks, at most ``scan_words`` words at a time; a
    larger one takes more scans of the documents. A null or empty text has no words, a null or empty item no
    window. Rows repeated in either table count as they come, items with one id as one. A hit by an item
    whose id is null counts as hit, not among the items. Other columns are ignored. Long texts are never
    cut; a batch is searched half a MB at a time, or one document.
    """
    state = documents.select("doc_id", "text", F.array().cast("array<array<long>>").alias("spans"),
                             F.array().cast("array<string>").alias("items"))
    for tables, last in _tables(benchmark, scan_words):
        state = state.mapInArrow(_scan(tables, last), _RESULT if last else _STATE)
        if not last:
            state = stored(state, "decontaminate")
    return state


def drop_contaminated(documents: DataFrame, benchmark: DataFrame,
                      scan_words: int = SCAN_WORDS) -> DataFrame:
    """The documents, with all their columns, in which no window of the benchmark occurs."""
    kept = documents
    for tables, _ in _tables(benchmark, scan_words):
        def work(batch: pa.RecordBatch, tables_in=tables) -> pa.RecordBatch:
            at = batch.schema.names.index("text")
            data, offsets = _words(batch.column(at))
            clean = np.ones(batch.num_rows, bool)
            for lo, hi in A.slices(data, offsets):
                of_doc, hit, _ = _search(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo],
                                         tables_in.value)
                doc = np.searchsorted(of_doc, np.flatnonzero(hit), "right") - 1
                clean[lo + doc] = False
            return batch.filter(pa.array(clean))
        kept = kept.mapInArrow(A.by_batch(work), documents.schema)
    return kept
