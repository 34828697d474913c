"""Suffix-array dedup: suffixes range-partitioned by a leading token, sorted by multikey quicksort, compared."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlode.llm import arrays as A
from ledgerlode.llm.repeats import WINDOW, Segments, part_count, range_minima, repeated_spans, removed, same_anchor

#: Bytes of the token that a window's suffix is filed under.
TOKEN = 20
_SAMPLE_DOCUMENTS = 2000
_SAMPLE_TOKENS = 50


def _leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on as one number, in the order of the bytes."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | data[at + k].astype(np.uint64)
    return out


def _tokens(data: np.ndarray) -> np.ndarray:
    """A digest of the ``TOKEN`` bytes from each place on: their eight-byte stretches, mixed in turn."""
    every = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,))
    n, out = len(data) - TOKEN + 1, None
    for k in [*range(0, TOKEN - 8, 8), TOKEN - 8]:
        stretch = every[k:k + n]
        out = A.mix(stretch.copy() if out is None else out + stretch)
    return out


def _cut(data: np.ndarray, offsets: np.ndarray) -> Segments:
    """File each 50-byte window under the token with the smallest digest among those inside it."""
    start = A.ranges(offsets[:-1], np.maximum(np.diff(offsets) - WINDOW + 1, 0))
    if not len(start):
        return Segments(*[np.zeros(0, np.int64)] * 4, *[np.zeros(0, np.uint64)] * 3, *[np.zeros(0, np.int64)] * 2)
    prefix = A.prefix_digests(A.BYTE[data])
    at = np.arange(len(data) - TOKEN + 1)
    token = _tokens(data)
    # The place in the low bits breaks ties to the left.
    ranked = (token >> np.uint64(34) << np.uint64(34)) | at.astype(np.uint64)
    anchor = (range_minima(ranked, start, start + WINDOW - TOKEN + 1) & np.uint64((1 << 34) - 1)).astype(np.int64)
    one, count = same_anchor(start, anchor)
    begin, anchor = start[one], anchor[one]
    row = np.searchsorted(offsets, begin, "right") - 1
    end = begin + count - 1 + WINDOW
    return Segments(row, begin - offsets[row], count, anchor - begin, token[anchor], _leading(data, anchor),
                    A.span_digests(prefix, begin, end), begin, end)


def multikey_sort(group: np.ndarray, columns) -> tuple[np.ndarray, np.ndarray]:
    """Order entries by group and then by keys of several columns, and say which differ from the one before.

    Multikey quicksort on eight bytes at a time: after each column only entries that still tie are sorted on.
    ``columns`` yields functions from entries to their values.
    """
    order = np.argsort(group, kind="stable")
    differs = np.ones(len(order), bool)
    differs[1:] = group[order][1:] != group[order][:-1]
    for column in columns:
        tied = ~differs
        tied[:-1] |= ~differs[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        block = np.cumsum(differs)[at]
        value = column(order[at])
        inner = np.lexsort((value, block))
        order[at] = order[at][inner]
        value = value[inner]
        differs[at[1:]] |= (value[1:] != value[:-1])
    return order, differs


def _compare(content: np.ndarray, offsets: np.ndarray, entry: np.ndarray, unit: np.ndarray,
             group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = offsets[entry] + unit
    steps = [*range(0, WINDOW - 8, 8), WINDOW - 8]
    return multikey_sort(group, [lambda rows, k=k: _leading(content, begin[rows] + k) for k in steps])


def sampled_splitters(documents: DataFrame, parts: int) -> np.ndarray:
    """Bounds of ``parts`` ranges of leading bytes, from tokens of a bounded sample of the documents. They
    decide the balance of the parts only."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = A.text_bytes(batch.column("text"))
        found = []
        for lo, hi in A.slices(data, offsets, 1 << 20):
            s = _cut(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            # Some tokens of each row, evenly spaced.
            place = np.arange(len(s.row)) - np.searchsorted(s.row, s.row)
            every = np.maximum(np.bincount(s.row, minlength=1)[s.row] // _SAMPLE_TOKENS, 1)
            found.append(s.order[place % every == 0])
        lead = np.concatenate(found) if found else np.zeros(0, np.uint64)
        return A.batch_of(lead=lead.view(np.int64))

    chosen = (documents.select(F.xxhash64("doc_id").alias("__hash")).orderBy("__hash").limit(_SAMPLE_DOCUMENTS)
                       .agg(F.max("__hash")).first()[0])
    sample = documents.where(F.xxhash64("doc_id") <= F.lit(chosen)).select("text").limit(2 * _SAMPLE_DOCUMENTS)
    lead = np.sort(sample.mapInArrow(A.by_batch(work), "lead long").toArrow().column("lead").to_numpy().view(np.uint64))
    if not len(lead):
        return np.zeros(0, np.uint64)
    return np.unique(lead[np.arange(1, parts) * len(lead) // parts])


def remove_repeated_bytes(documents: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for each document.

    A byte goes when a 50-byte string covers it that also starts in a document with a smaller id. Strings are
    those of the input; they may overlap and never cross documents.

    The suffixes at all places are compared as far as 50 bytes. They are filed under the token of 20 bytes in
    the string with the smallest digest, not under their first bytes: suffixes that follow each other then stay
    in one segment and share its bytes, where each by itself would carry 50. Sampled splitters range-partition the
    tokens by their leading bytes; equal tokens are never parted, so a string meets all its equals in one
    bucket, and bounds between buckets part no equal strings. A bucket sorts its suffixes by multikey quicksort and
    compares neighbours. Equal segments meet as one, led by the smallest document, already within a batch.

    A null text is empty. Rows with a null id are kept whole and remove nothing. Rows with equal ids remove nothing
    from each other. Other columns are ignored; an empty table gives no rows.
    """
    documents = documents.select("doc_id", "text")
    parts, buckets = part_count(documents)
    found = repeated_spans(documents, _cut, _compare, sampled_splitters(documents, parts), buckets)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = A.text_bytes(batch.column("text"))
        counts, kept = [], []
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            text = data[offsets[i]:offsets[i + 1]]
            gone = removed(spans, len(text))
            counts.append((len(text), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())))
            kept.append(text[~gone].tobytes())
        n = np.array(counts, np.int64)
        return A.batch_of(doc_id=batch.column("doc_id"), n_bytes=n[:, 0], n_removed=n[:, 1], n_spans=n[:, 2],
                          kept_sha256=[hashlib.sha256(k).hexdigest() for k in kept], kept=pa.array(kept, pa.binary()))

    return found.mapInArrow(A.by_batch(work), "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                              "kept_sha256 string, kept binary")
