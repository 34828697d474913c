"""Vector code compression: integer codebooks by part, nearest entries through remembered grid cells.

A part of a vector lies in a cell of a grid. Of a codebook's entries only those can be nearest to any point of the
cell whose least distance to it is not above the smallest greatest distance that some entry has. These entries are
worked out once a cell and remembered; only they are compared exactly. All arithmetic is on whole numbers, so
the grid's width changes the work and never a result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlode.llm.arrays import ranges
from ledgerlode.sources.files import stored

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
HOT_SHARE = 1000               # a label with at least one row in so many is hot: there are at most as many of them
_CELLS, _AT_ONCE, _PAIRS, _ROWS = 50_000, 64, 1 << 19, 4096
_LIMB = 32
_SAFE = 1 << 62
_LONG = (1 << 63) - 1


def whole(values: np.ndarray) -> np.ndarray:
    """floor(1024 x) of finite numbers: int64, or Python integers where one is too large for it."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values.astype(np.float64) * SCALE)
    if not scaled.size or np.abs(scaled).max() < 2.0**50:
        return scaled.astype(np.int64)
    out = np.array([int(s) if math.isfinite(s) else int(v) * SCALE
                    for s, v in zip(scaled.ravel().tolist(), values.ravel().tolist())], object)
    return out.reshape(values.shape)


def _largest(x: np.ndarray) -> int:
    return int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0


class Book:
    """The entries of one part position, and the candidates of the cells met so far."""

    def __init__(self, entries: list[list[int]]):
        self.rows = np.array(entries, object)
        self.bound = _largest(self.rows)
        self.width = self._width()
        self.cells: dict[bytes, np.ndarray] = {}

    def _width(self) -> int:
        """A power of two near half the mean distance to the next entry, by dimension."""
        points = self.rows.astype(np.float64)
        if len(points) < 2 or not np.isfinite(points).all() or self.bound > 1 << 100:
            return 1 << 5
        square = (points * points).sum(1)
        apart = square[:, None] + square[None] - 2 * points @ points.T
        np.fill_diagonal(apart, np.inf)
        side = math.sqrt(max(float(np.sqrt(np.maximum(apart.min(1), 0)).mean()), 1.0) ** 2 / points.shape[1]) / 2
        return 1 << max(0, int(math.log2(max(side, 1))))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each point, the lower index at a tie."""
        dims = points.shape[1]
        largest = max(_largest(points), self.bound) + self.width
        furthest = dims * (2 * largest) ** 2
        kind = np.int32 if furthest < 1 << 31 else np.int64 if furthest < _SAFE else object
        points, entries = points.astype(kind), self.rows.astype(kind)
        cells = points // self.width
        keys = _keys(cells)
        names, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        found: list[np.ndarray | None] = [self.cells.get(n) for n in names.tolist()]
        lost = [i for i, f in enumerate(found) if f is None]
        if len(self.cells) + len(lost) > _CELLS:
            self.cells = {}
        for lo in range(0, len(lost), _AT_ONCE):
            some = lost[lo:lo + _AT_ONCE]
            for i, kept in zip(some, self._candidates(cells[first[some]] * self.width, entries), strict=True):
                found[i] = self.cells[names[i]] = kept
        sizes = np.array([len(f) for f in found])
        flat, starts = np.concatenate(found).astype(np.int64), np.concatenate(([0], np.cumsum(sizes)))
        index, apart = np.empty(len(points), np.int64), np.empty(len(points), kind)
        for lo, hi in _bounded(sizes[inverse]):
            cell = inverse[lo:hi]
            mine = sizes[cell]
            entry = flat[ranges(starts[cell], mine)]
            gap = points[lo:hi][np.repeat(np.arange(hi - lo), mine)] - entries[entry]
            far = (gap * gap).sum(1)
            begin = np.concatenate(([0], np.cumsum(mine)[:-1]))
            least = np.minimum.reduceat(far, begin)
            hit = np.flatnonzero(far == np.repeat(least, mine))
            index[lo:hi] = entry[hit[np.searchsorted(hit, begin)]]
            apart[lo:hi] = least
        return index, apart

    def _candidates(self, low: np.ndarray, entries: np.ndarray) -> Iterator[np.ndarray]:
        """The entries not dominated across each box from ``low`` to ``low + width - 1``, in order."""
        least = np.zeros((len(low), len(entries)), entries.dtype)
        most, near, far = np.zeros_like(least), np.empty_like(least), np.empty_like(least)
        last = entries.dtype.type(self.width - 1) if entries.dtype != object else self.width - 1
        low = low.astype(entries.dtype)
        for k in range(entries.shape[1]):
            np.subtract(entries[None, :, k], low[:, None, k], out=near)      # above the lower side
            np.subtract(last, near, out=far)                                 # below the upper side
            np.minimum(near, far, out=near)                                  # negative outside the box
            np.subtract(last, near, out=far)                                 # the side further away
            np.multiply(far, far, out=far)
            most += far
            np.minimum(near, 0, out=near)
            np.multiply(near, near, out=near)
            least += near
        inside = least <= most.min(1)[:, None]
        columns, ends = np.nonzero(inside)[1].astype(np.int32), np.cumsum(inside.sum(1)).tolist()
        for begin, end in zip([0, *ends], ends):
            yield columns[begin:end]


def _keys(cells: np.ndarray) -> np.ndarray:
    if cells.dtype == object:
        out = np.empty(len(cells), object)
        out[:] = [",".join(map(str, row)).encode() for row in cells.tolist()]
        return out
    rows = np.ascontiguousarray(cells)
    return np.array([r.tobytes() for r in rows], object)


def _bounded(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of points whose comparisons fit into memory, at least one point each."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + _PAIRS, "right")))
        yield lo, hi
        lo = hi


def finite(vector: str) -> Column:
    """Whether a vector has components, all of them finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _slices(batches, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, _ROWS):
            part = batch.slice(lo, _ROWS)
            yield part, whole(_matrix(part.column("__vector"), dims))


def _part_sums(rows: DataFrame, books: list[list[list[int]]], dims: int) -> list:
    """For each part, entry and position the sum of the assigned parts, as (part, entry, position, limb, value);
    position -1 counts them. One row per limb, so that no sum is too large; at most as many as the codebooks hold."""
    width = dims // PARTS

    def work(batches):
        books_ = [Book(b) for b in books]
        sums = [np.zeros((len(b), width), object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for _, points in _slices(batches, dims):
            for p, book in enumerate(books_):
                mine = points[:, p * width:(p + 1) * width]
                index, _ = book.nearest(mine)
                order = np.argsort(index, kind="stable")
                used, begin = np.unique(index[order], return_index=True)
                if len(used):
                    sums[p][used] += np.add.reduceat(mine[order], begin, axis=0)
                    counts[p] += np.bincount(index, minlength=len(counts[p]))
        out = []
        for p in range(PARTS):
            for e in np.flatnonzero(counts[p]).tolist():
                out.append((p, e, -1, 0, int(counts[p][e])))
                for at, value in enumerate(sums[p][e].tolist()):
                    out += [(p, e, at, limb, v) for limb, v in enumerate(_limbs(int(value)))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                             ["part", "entry", "position", "limb", "value"])

    names = ["part", "entry", "position", "limb"]
    partial = rows.select("__vector").mapInArrow(work, ", ".join(f"{n} long" for n in [*names, "value"]))
    return partial.groupBy(*names).agg(F.sum("value").alias("value")).collect()


def _limbs(value: int) -> list[int]:
    """The value in steps of 32 bits, the last one signed and of 32 bits at most."""
    out = []
    while not -(1 << _LIMB - 1) <= value < 1 << _LIMB - 1:
        out.append(value & (1 << _LIMB) - 1)
        value >>= _LIMB
    return [*out, value]


def _moved(books: list[list[list[int]]], sums: list) -> list[list[list[int]]]:
    """Each entry that parts were assigned to at the floor of their mean."""
    count = {(r.part, r.entry): r.value for r in sums if r.position < 0}
    total: dict[tuple[int, int, int], int] = {}
    for r in sums:
        if r.position >= 0:
            at = (r.part, r.entry, r.position)
            total[at] = total.get(at, 0) + (r.value << _LIMB * r.limb)
    return [[[total[p, e, at] // count[p, e] for at in range(len(entry))] if (p, e) in count else entry
             for e, entry in enumerate(book)] for p, book in enumerate(books)]


def compress(embeddings: DataFrame, vector: str = "embedding", rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for each vector kept.

    Dropped are vectors that are null, empty or hold null or non-finite components, and those of another length than
    the kept vector of the smallest id; a length that four does not divide is an error. The codebooks start from the
    kept rows with the smallest ids (at a tie the smaller vector, null ids last), 256 or, in a smaller table, all.
    Repeated rows are rows of their own. ``error`` and ``label_error`` are null where they exceed a long. Other
    columns are ignored; an empty table, or one without a vector to keep, gives no rows.

    A round is one scan of the vectors and sends the sums of each task, at most the codebooks' size. The codebooks
    pass through the driver: 256 entries of four parts, whatever the input.
    """
    id_type, label_type = embeddings.schema["vec_id"].dataType, embeddings.schema["label"].dataType
    kept = embeddings.select("vec_id", "label", F.col(vector).alias("__vector")).where(finite("__vector"))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "__vector").limit(1).collect()
    dims = len(first[0]["__vector"]) if first else 0
    if dims % PARTS:
        raise ValueError(f"vectors of {dims} components cannot be cut into {PARTS} equal parts")
    kept = kept.where(F.size("__vector") == dims)
    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "__vector").limit(ENTRIES).collect()
    points = whole(np.array([r["__vector"] for r in seeds], np.float64).reshape(len(seeds), dims)).tolist()
    width = dims // PARTS
    books = [[row[p * width:(p + 1) * width] for row in points] for p in range(PARTS)]
    for _ in range(rounds if seeds else 0):
        books = _moved(books, _part_sums(kept, books, dims))

    def work(batches):
        books_ = [Book(b) for b in books]
        for part, values in _slices(batches, dims):
            near = [b.nearest(values[:, p * width:(p + 1) * width]) for p, b in enumerate(books_)]
            codes = ["".join(map("{:02x}".format, row)) for row in zip(*[i.tolist() for i, _ in near])]
            errors = [sum(row) for row in zip(*[d.tolist() for _, d in near])]
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), part.column("label"), pa.array(codes, pa.string()),
                 pa.array([e if e <= _LONG else None for e in errors], pa.int64())],
                ["vec_id", "label", "code", "error"])

    schema = T.StructType([T.StructField("vec_id", id_type), T.StructField("label", label_type),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = stored(kept.mapInArrow(work, schema), "vector-codes")
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return _with_label_error(coded).select("vec_id", "code", "error", "label_error",
                                           F.lit(digest).alias("codebooks_sha256"))


def _with_label_error(coded: DataFrame) -> DataFrame:
    """Add the error summed over the rows with the same label, nulls together.

    At most ``HOT_SHARE`` labels can each have one row in so many: their sums are broadcast. Rows of the others meet
    their sums by a shuffle, in which no label is large."""
    total = F.when(F.count_if(F.col("error").isNull()) == 0, F.sum(F.col("error").cast("decimal(38,0)")))
    sums = stored(coded.groupBy(F.col("label").alias("__label")).agg(
        F.count(F.lit(1)).alias("__n"), total.try_cast("long").alias("label_error")), "label-errors")
    everything = coded.count()
    is_hot = F.col("__n") * HOT_SHARE >= F.lit(everything)
    same = F.col("label").eqNullSafe(F.col("__label"))
    hot = F.broadcast(sums.where(is_hot))
    cold = coded.join(hot, same, "left_anti").join(sums.where(~is_hot), same)
    return coded.join(hot, same).unionByName(cold)


def code_sql(rounds: int = ROUNDS) -> str:
    """The same in DuckDB, every part against every entry."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT r, part, min(d * 256 + entry) AS best FROM (
    SELECT r, part, entry, sum((x - c) * (x - c)) AS d FROM comp JOIN book{k} USING (part, pos) GROUP BY ALL)
  GROUP BY ALL)""")
        if k < rounds:
            steps.append(f"""
book{k + 1} AS MATERIALIZED (
  SELECT part, entry, pos, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM book{k} LEFT JOIN (
    SELECT part, best % 256 AS entry, pos, sum(x)::HUGEINT AS s, count(*) AS n
    FROM comp JOIN near{k} USING (r, part) GROUP BY ALL) USING (part, entry, pos))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, len(embedding) // 4 AS w,
         [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
comp AS MATERIALIZED (
  SELECT r, i // w AS part, i % w AS pos, x
  FROM (SELECT r, w, unnest(range(len(v))) AS i, unnest(v) AS x FROM kept)),
book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, pos, x::HUGEINT AS c FROM comp WHERE r <= 256),{",".join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', (best % 256)::INTEGER), '' ORDER BY part) AS code, sum(best // 256)::BIGINT AS error
  FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""
