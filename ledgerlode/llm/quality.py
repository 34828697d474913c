"""Quality classifier: averaged embeddings of words and character n-grams, softmax, numpy SGD."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlode.llm import arrays as A

THRESHOLD = 0.3


@dataclass(frozen=True)
class Settings:
    """``fit_rows`` bounds the labelled rows that the model is fitted on; scoring reads every row."""

    fit_rows: int = 4000
    buckets: int = 1 << 16
    dim: int = 12
    grams: tuple[int, ...] = (3, 4)
    epochs: int = 6
    rate: float = 0.5
    seed: int = 7


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _features(data: np.ndarray, offsets: np.ndarray, settings: Settings):
    """Distinct words of the rows with their buckets, and which word stands where.

    Returns the offsets of each row's words in ``word``, the number of the distinct word at each place, and per
    distinct word its buckets: the word itself and its character n-grams, with marks for start and end.
    """
    starts, ends, of_row = A.find_words(data, offsets)
    digests = A.byte_digests(data, starts, ends)
    kinds, one, word = np.unique(digests, return_index=True, return_inverse=True)
    mask = np.uint64(settings.buckets - 1)
    size = ends[one] - starts[one]
    marked = np.zeros(int(size.sum() + 2 * len(size)), np.uint8)
    at = np.concatenate(([0], np.cumsum(size + 2)))
    marked[A.ranges(at[:-1] + 1, size)] = data[A.ranges(starts[one], size)]
    marked[at[1:] - 1] = 1
    owner, bucket = [np.arange(len(kinds))], [kinds & mask]
    for n in settings.grams:
        count = np.maximum(size + 2 - n + 1, 0)
        begin = A.ranges(at[:-1], count)
        owner.append(np.repeat(np.arange(len(kinds)), count))
        bucket.append(A.byte_digests(marked, begin, begin + n) & mask)
    return of_row, word, np.concatenate(owner), np.concatenate(bucket).astype(np.int64)


def _row_features(data, offsets, settings):
    """Per row its distinct buckets and how often each occurs; bucket 0 also counts the end of the text."""
    of_row, word, owner, bucket = _features(data, offsets, settings)
    order = np.argsort(owner, kind="stable")
    bucket, edge = bucket[order], np.searchsorted(owner[order], np.arange(int(word.max(initial=-1)) + 2))
    for i in range(len(offsets) - 1):
        mine, times = np.unique(word[of_row[i]:of_row[i + 1]], return_counts=True)
        count = edge[mine + 1] - edge[mine]
        total = np.bincount(bucket[A.ranges(edge[mine], count)], np.repeat(times, count), settings.buckets)
        total[0] += 1
        used = np.flatnonzero(total)
        yield used, total[used] / total.sum()


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, settings: Settings) -> np.ndarray:
    """What each bucket adds to the log-odds of label 1, out of the trained embeddings and output layer."""
    draw = np.random.default_rng(settings.seed)
    inside = draw.uniform(-1, 1, (settings.buckets, settings.dim)) / settings.dim
    output = np.zeros((settings.dim, 2))
    if len(set(labels.tolist())) == 2:
        steps, done = settings.epochs * len(rows), 0
        for _ in range(settings.epochs):
            for i in draw.permutation(len(rows)):
                used, share = rows[i]
                rate = settings.rate * (1 - done / steps)
                done += 1
                hidden = share @ inside[used]
                score = hidden @ output
                chance = np.exp(score - score.max())
                chance /= chance.sum()
                chance[labels[i]] -= 1
                back = output @ chance
                output -= rate * np.outer(hidden, chance)
                inside[used] -= rate * np.outer(share, back) * min(len(used), 50)
    return (inside @ (output[:, 1] - output[:, 0])).astype(np.float64)


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """The model, fitted on at most ``settings.fit_rows`` labelled documents outside the held-out fifth: those
    with the smallest hashes of their id. Their texts are read whole, in one task. With no labels, or labels of
    one value only, every score will be 0.5."""
    usable = F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    chosen = (labels.where(usable).groupBy("doc_id").agg(F.max("quality").alias("__quality"))
                    .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.fit_rows)
                    .withColumnRenamed("doc_id", "__chosen"))
    sample = (documents.select("doc_id", "text")
                       .join(F.broadcast(chosen), F.col("doc_id") == F.col("__chosen"))
                       .select("doc_id", "text", F.col("__quality").cast("int").alias("quality"),
                               F.xxhash64("doc_id", "text").alias("__order"))
                       .orderBy("__order", "doc_id").limit(settings.fit_rows)
                       .withColumn("__all", F.lit(0)))

    def learn(table: pa.Table) -> pa.Table:
        data, offsets = A.text_bytes(table.column("text"))
        rows = []
        for lo, hi in A.slices(data, offsets):
            rows += _row_features(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], settings)
        weights = train(rows, table.column("quality").to_numpy().astype(np.int64), settings)
        del rows, data
        A.give_back()
        return pa.table({"weights": pa.array([weights.tobytes()], pa.binary())})

    model = sample.groupBy("__all").applyInArrow(learn, "weights binary").first()
    return np.frombuffer(model[0]) if model else np.zeros(settings.buckets)


def _scores(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, settings: Settings) -> np.ndarray:
    out = np.zeros(len(offsets) - 1)
    for lo, hi in A.slices(data, offsets):
        of_row, word, owner, bucket = _features(data[offsets[lo]:offsets[hi]],
                                                offsets[lo:hi + 1] - offsets[lo], settings)
        kinds = int(word.max(initial=-1)) + 1
        of_word = np.bincount(owner, weights[bucket], kinds)[word]
        n_word = np.bincount(owner, minlength=kinds)[word]
        row = np.repeat(np.arange(hi - lo), np.diff(of_row))
        total = np.bincount(row, of_word, hi - lo) + weights[0]
        out[lo:hi] = total / (np.bincount(row, n_word, hi - lo) + 1)
    return 1 / (1 + np.exp(-out))


def score(documents: DataFrame, weights: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each document, from its whole text alone.

    An empty or null text is scored by the feature that ends each text. Repeated rows get equal scores. Other
    columns are ignored; an empty table gives no rows.
    """
    model = documents.sparkSession.sparkContext.broadcast(weights)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = _scores(*A.text_bytes(batch.column("text")), model.value, settings)
        return A.batch_of(doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), score=scores,
                          predicted=(scores >= THRESHOLD).astype(np.int32))

    return (documents.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
                     .mapInArrow(A.by_batch(work), "doc_id long, held_out boolean, score double, predicted int"))


def keep_good(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents, with all their columns, that score at least the threshold."""
    model = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, settings))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch.column(batch.schema.names.index("text"))
        return batch.filter(pa.array(_scores(*A.text_bytes(text), model.value, settings) >= THRESHOLD))

    return documents.mapInArrow(A.by_batch(work), documents.schema)
