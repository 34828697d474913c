"""Substring dedup by recompression: equal passages get equal symbols inside, whatever stands around them."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlode.llm import arrays as A
from ledgerlode.llm.repeats import WINDOW, Segments, part_count, range_minima, repeated_spans, removed, same_anchor

ROUNDS = 4
#: Symbols of so many words are taken before shorter ones.
_LONG = 4
_RUN, _PAIR, _SIDE, _WORD = (np.uint64(x) for x in (0x5EED0001, 0x5EED0002, 0x5EED0003, 0x5EED0004))


@dataclass
class Symbols:
    """Names of the symbols of a sequence, the first word of each, and the words [low, high) that decide that it is
    there: equal words there give the same symbol at the same place."""

    name: np.ndarray
    start: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _neighbours(s: Symbols, border: np.ndarray):
    """The range of words that also holds the symbols before and after. Next to the border of a document it
    reaches beyond it."""
    before, after = np.empty_like(s.low), np.empty_like(s.high)
    before[1:], after[:-1] = s.low[:-1], s.high[1:]
    first = np.searchsorted(s.start, border[:-1])
    last = np.searchsorted(s.start, border[1:]) - 1
    before[first] = border[:-1] - 1
    after[last] = border[1:] + 1
    return before, after, first, last


def compress_runs(s: Symbols, border: np.ndarray) -> Symbols:
    """Each run of one symbol becomes a symbol named by it and the length."""
    before, after, first, _ = _neighbours(s, border)
    fresh = np.ones(len(s.name), bool)
    fresh[1:] = s.name[1:] != s.name[:-1]
    fresh[first] = True
    head = np.flatnonzero(fresh)
    count = np.diff(np.append(head, len(fresh)))
    name = np.where(count > 1, A.mix(s.name[head] ^ A.mix(count.astype(np.uint64) + _RUN)), s.name[head])
    return Symbols(name, s.start[head], before[head], after[head + count - 1])


def compress_pairs(s: Symbols, border: np.ndarray, turn: int) -> Symbols:
    """Names fall to the left or the right side by a hash of the round; a left one before a right one become a pair,
    named by both."""
    before, after, first, _ = _neighbours(s, border)
    left = (A.mix(s.name + A.mix(np.array([turn], np.uint64) + _SIDE)) & np.uint64(1)).astype(bool)
    joined = np.zeros(len(left), bool)
    joined[:-1] = left[:-1] & ~left[1:]
    joined[first[first > 0] - 1] = False
    taken = np.zeros(len(left), bool)
    taken[1:] = joined[:-1]
    head = np.flatnonzero(~taken)
    pair = joined[head]
    following = np.minimum(head + 1, len(left) - 1)
    name = np.where(pair, A.mix(s.name[head] * np.uint64(3) + A.mix(s.name[following] + _PAIR)), s.name[head])
    low = np.where(pair | left[head], s.low[head], before[head])
    high = np.where(pair, s.high[following], np.where(left[head], after[head], s.high[head]))
    return Symbols(name, s.start[head], low, high)


def recompress(words: np.ndarray, border: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    """The symbols after some rounds over the word digests of several documents with the given borders. A name is
    a digest of what it stands for, so all tasks give the same names with no dictionary between them."""
    at = np.arange(len(words))
    s = Symbols(words, at, at, at + 1)
    for turn in range(rounds):
        s = compress_pairs(compress_runs(s, border), border, turn)
    return s


def _cut(data: np.ndarray, offsets: np.ndarray) -> Segments:
    """File each window of 50 words under one of the symbols that lie inside it with all that decides them: a long one
    before a short one, then the smallest name; under its smallest word where there is none."""
    starts, ends, of_row = A.find_words(data, offsets)
    start = A.ranges(of_row[:-1], np.maximum(np.diff(of_row) - WINDOW + 1, 0))
    if not len(start):
        return Segments(*[np.zeros(0, np.int64)] * 4, *[np.zeros(0, np.uint64)] * 3, *[np.zeros(0, np.int64)] * 2)
    words = A.byte_digests(data, starts, ends)
    filled = np.flatnonzero(np.diff(of_row) > 0)
    s = recompress(words, np.append(of_row[filled], of_row[-1]))
    low = np.searchsorted(s.low, start, "left")
    high = np.searchsorted(s.high, start + WINDOW, "right")
    length = np.diff(np.append(s.start, len(words)))
    short = (length < _LONG).astype(np.uint64) << np.uint64(63)
    places = np.uint64((1 << 30) - 1)

    def ranked(names, top):
        return top | (A.mix(names) >> np.uint64(1) & ~places) | np.arange(len(names), dtype=np.uint64)

    some = high > low
    anchor, name = np.empty(len(start), np.int64), np.empty(len(start), np.uint64)
    best = (range_minima(ranked(s.name, short), low[some], high[some]) & places).astype(np.int64)
    anchor[some], name[some] = s.start[best], s.name[best]
    bare = start[~some]
    best = (range_minima(ranked(words, np.uint64(0)), bare, bare + WINDOW) & places).astype(np.int64)
    anchor[~some], name[~some] = best, A.mix(words[best] + _WORD)
    # A symbol and a word at one place are different anchors.
    one, count = same_anchor(start, 2 * anchor + some)
    begin, end = start[one], start[one] + count - 1 + WINDOW
    row = np.searchsorted(of_row, begin, "right") - 1
    name = A.mix(name[one])
    return Segments(row, begin - of_row[row], count, anchor[one] - begin, name, name,
                    A.sequence_digests(words, begin, end), starts[begin], ends[end - 1])


def _compare(content: np.ndarray, offsets: np.ndarray, entry: np.ndarray, unit: np.ndarray,
             group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order windows by group and content. Equal ones are equal in a digest of all 50 words besides their symbol."""
    starts, ends, of_row = A.find_words(content, offsets)
    words = A.byte_digests(content, starts, ends)
    begin = of_row[entry] + unit
    value = A.sequence_digests(words, begin, begin + WINDOW)
    order = np.lexsort((value, group))
    differs = np.ones(len(order), bool)
    differs[1:] = (group[order][1:] != group[order][:-1]) | (value[order][1:] != value[order][:-1])
    return order, differs


def remove_repeated_words(documents: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for each document.

    A word goes when a window of 50 consecutive words covers it that also starts in a document with a smaller id.
    Words are split at white space and compared as they are; windows are those of the input.

    Recompression: in each round runs of one symbol and pairs across a hashed division of the symbols get new
    names, the same in all documents. What decides a symbol is known to the word, so a window takes as anchor a
    symbol that its own words decide: equal windows have equal anchors. Windows meet by anchor (``repeats``).
    A window with none, such as the inside of a long run, has its smallest word instead.

    A null text has no words. Rows with a null id are kept whole and remove nothing. Rows with equal ids remove
    nothing from each other. Other columns are ignored; an empty table gives no rows.
    """
    documents = documents.select("doc_id", "text")
    parts, buckets = part_count(documents)
    splitters = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    found = repeated_spans(documents, _cut, _compare, splitters, buckets)

    def work(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        out = []
        data, offsets = A.text_bytes(batch.column("text"))
        spans = batch.column("spans").to_pylist()
        for lo, hi in A.slices(data, offsets):
            part = data[offsets[lo]:offsets[hi]]
            starts, ends, of_row = A.find_words(part, offsets[lo:hi + 1] - offsets[lo])
            raw, counts, kept = part.tobytes(), [], []
            for i in range(hi - lo):
                a, b = of_row[i], of_row[i + 1]
                gone = removed(spans[lo + i], b - a)
                left = a + np.flatnonzero(~gone)
                counts.append((b - a, int(gone.sum())))
                kept.append(b" ".join([raw[x:y] for x, y in zip(starts[left].tolist(), ends[left].tolist(), strict=True)]))
            n = np.array(counts, np.int64)
            out.append(A.batch_of(doc_id=batch.column("doc_id").slice(lo, hi - lo), n_words=n[:, 0], n_removed=n[:, 1],
                                  kept_sha256=[hashlib.sha256(k).hexdigest() for k in kept],
                                  kept=pa.array(kept, pa.binary()).cast(pa.string())))
        return out

    return found.mapInArrow(A.by_batch(work), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
