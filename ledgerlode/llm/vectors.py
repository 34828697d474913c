"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, multiprobe, verified pairs."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlode.llm import arrays as A
from ledgerlode.llm.components import components
from ledgerlode.llm.ngrams import _least_labels
from ledgerlode.sources.files import stored


@dataclass(frozen=True)
class Hashing:
    """``tables`` hash tables; a bucket is named by ``hashes`` polytope corners, and a vector is put under the
    ``probes`` nearest corners of each. ``block`` bounds the rows that are multiplied at once."""

    tables: int = 8
    hashes: int = 2
    probes: int = 2
    block: int = 1024
    seed: int = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row (a power of two wide), in log2 rounds of sums."""
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x


def bucket_keys(x: np.ndarray, hashing: Hashing) -> np.ndarray:
    """The names of the buckets of each row, ``tables * probes ** hashes`` of them."""
    width = 1 << max(1, int(x.shape[1] - 1).bit_length())
    wide = np.zeros((len(x), width))
    wide[:, :x.shape[1]] = x
    draw = np.random.default_rng([hashing.seed, x.shape[1]])
    out = []
    for table in range(hashing.tables):
        names = np.full((len(x), 1), table + 1, np.uint64)
        for _ in range(hashing.hashes):
            turned = wide
            for _ in range(3):
                turned = hadamard(turned * draw.choice([-1.0, 1.0], width))
            near = np.argpartition(-np.abs(turned), hashing.probes - 1, axis=1)[:, :hashing.probes]
            corner = 2 * near + (np.take_along_axis(turned, near, axis=1) < 0)
            names = A.mix(names[:, :, None] * np.uint64(1 << 32) + names[:, :, None] // np.uint64(1 << 32)
                          + corner[:, None, :].astype(np.uint64) + np.uint64(1)).reshape(len(x), -1)
        out.append(names)
    return np.concatenate(out, axis=1)


def _matrix(column) -> np.ndarray:
    data, offsets = A.text_bytes(column)
    return np.frombuffer(data.tobytes(), np.float64).reshape(len(offsets) - 1, -1)


def _keys(hashing: Hashing):
    def work(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        out = []
        sizes = batch.column("dim").to_numpy()
        for dim in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == dim)
            part = batch.take(pa.array(rows))
            keys = bucket_keys(_matrix(part.column("vector")), hashing)
            label = part.column("label").to_numpy().astype(np.int64).view(np.uint64)
            keys = A.mix(keys + A.mix(label + np.uint64(dim << 40))[:, None])
            out.append(A.batch_of(bucket=keys.ravel().view(np.int64),
                                  node=np.repeat(part.column("node").to_numpy(), keys.shape[1])))
        return out
    return A.by_batch(work)


def _pairs(hashing: Hashing, threshold: float):
    """Links inside the blocks of one part, each counted in one of the buckets that its ends share."""
    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        bucket, low, high = (table.column(n).to_numpy() for n in ("bucket", "low", "high"))
        node, side, dim = (table.column(n).to_numpy() for n in ("node", "side", "dim"))
        label, size = table.column("label").to_numpy(), table.column("size").to_numpy()
        raw, offsets = A.text_bytes(table.column("vector"))
        order = np.lexsort((node, side, label, dim, high, low, bucket))
        fields = np.stack([bucket, low, high, dim, label])[:, order]
        edge = np.flatnonzero(np.concatenate(([True], (fields[:, 1:] != fields[:, :-1]).any(axis=0), [True])))
        # The buckets of each vector of this part, worked out once.
        one, where = np.unique(node, return_index=True, return_inverse=True)[1:]
        own = np.empty(len(one), object)
        for d in np.unique(dim[one]).tolist():
            at = np.flatnonzero(dim[one] == d)
            x = np.stack([raw[offsets[i]:offsets[i + 1]].view(np.float64) for i in one[at]])
            for start in range(0, len(at), 4096):
                some = slice(start, start + 4096)
                keys = np.sort(_own_keys(x[some], label[one[at[some]]], hashing).view(np.int64), axis=1)
                own[at[some]] = list(keys)
        counts: dict[int, int] = {}
        links = [np.zeros((2, 0), np.int64)]
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            rows = order[a:b]
            if len(rows) < 2:
                continue
            x = np.stack([raw[offsets[i]:offsets[i + 1]].view(np.float64) for i in rows])
            length = np.sqrt((x * x).sum(axis=1))
            linked = (x @ x.T) / (length[:, None] * length[None, :]) >= threshold
            np.fill_diagonal(linked, False)
            if low[rows[0]] != high[rows[0]]:
                linked &= side[rows][:, None] != side[rows][None, :]
            if not linked.any():
                continue
            label_of = _least_labels(linked)
            moved = label_of != np.arange(len(rows))
            links.append(np.stack([node[rows[label_of[moved]]], node[rows[moved]]]))
            # Of the buckets that both ends have, the least counts the link.
            first, second = np.nonzero(np.triu(linked))
            keys = np.stack(own[where[rows]])
            here = bucket[rows[0]]
            smaller = keys < here
            counted = np.ones(len(first), bool)
            for k in range(keys.shape[1]):
                mine = smaller[first, k]
                if not mine.any():
                    break
                at = np.flatnonzero(mine & counted)
                counted[at] = ~(keys[second[at]] == keys[first[at], k][:, None]).any(axis=1)
            for i, j in ((first[counted], second[counted]), (second[counted], first[counted])):
                add = np.bincount(i, size[rows[j]], len(rows))
                for r in np.flatnonzero(add).tolist():
                    counts[int(node[rows[r]])] = counts.get(int(node[rows[r]]), 0) + int(add[r])
        pairs = np.unique(np.concatenate(links, axis=1), axis=1)
        n = len(counts)
        return pa.table({"a": np.concatenate([pairs[0], np.fromiter(counts, np.int64, n)]),
                         "b": pa.array(np.concatenate([pairs[1], np.zeros(n, np.int64)]),
                                       mask=np.arange(pairs.shape[1] + n) >= pairs.shape[1]),
                         "links": np.concatenate([np.zeros(pairs.shape[1], np.int64),
                                                  np.fromiter(counts.values(), np.int64, n)])})
    return work


def _own_keys(x: np.ndarray, label: np.ndarray, hashing: Hashing) -> np.ndarray:
    keys = bucket_keys(x, hashing)
    return A.mix(keys + A.mix(label.astype(np.int64).view(np.uint64) + np.uint64(x.shape[1] << 40))[:, None])


def near_vectors(embeddings: DataFrame, threshold: float = 0.93, hashing: Hashing = Hashing()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each vector.

    Vectors with equal labels and as many components are linked when their cosine, in double precision, is at
    least the threshold. Each vector is turned by three rounds of random signs and a Hadamard transform, and named
    by the nearest corners of the cross-polytope; vectors that share a bucket in any table are compared
    exactly. So no pair below the threshold is linked, and a pair above it is missed only when all tables
    part it (``tests/llm/test_operators.py`` measures the recall). Labels that are not whole numbers are compared by a
    64-bit hash. A vector and its product with a power of two are equal.

    Equal vectors of one label are one class, led by its smallest id, and count as linked with each other. Only
    buckets with several classes are compared; a large bucket is cut into chunks that meet two at a time, and a
    pair is counted in the least of the buckets it shares, so pairs are never written out. A vector that is
    null, zero, or holds a null or a number that is not finite links with nothing, as do null labels
    and null ids; its component is its own id. Repeated rows count separately. Other columns are ignored. An
    empty table gives no rows.
    """
    spark = embeddings.sparkSession
    # Doubles as bytes: the digest of equal vectors is equal, and blocks read them without a copy.
    value = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    sound = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
             & (F.size("embedding") > 0)
             & F.forall(value, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))
             & F.exists(value, lambda v: v != 0.0))
    whole = isinstance(embeddings.schema["label"].dataType, T.IntegralType)
    label = F.col("label").cast("long") if whole else F.when(F.col("label").isNotNull(), F.xxhash64("label"))
    rows = embeddings.select("vec_id", label.alias("label"), value.alias("values"),
                             F.coalesce(sound, F.lit(False)).alias("sound"))

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("values")
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        edge = np.concatenate(([0], np.cumsum(size)))
        # The largest component comes near one, exactly, so that no square leaves the range of doubles.
        if len(size):
            _, power = np.frexp(np.maximum.reduceat(np.abs(flat), edge[:-1]))
            flat = np.ldexp(flat, -np.repeat(power, size)) + 0.0
        blobs = [flat[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
        return A.batch_of(vec_id=batch.column("vec_id"), label=batch.column("label"), dim=size,
                          vector=pa.array(blobs, pa.binary()))

    vectors = stored(rows.where("sound").drop("sound").mapInArrow(
        A.by_batch(pack), "vec_id long, label long, dim long, vector binary"), "vectors")
    classes = stored(vectors.groupBy("label", "dim", "vector")
                            .agg(F.min("vec_id").alias("lead"), F.count(F.lit(1)).alias("size"))
                            .withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    keys = stored(classes.select("node", "label", "dim", "vector").mapInArrow(
        _keys(hashing), "bucket long, node long").distinct(), "vector-keys")
    shared = (keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
                  .select("bucket", F.ceil(F.col("rows") / hashing.block).alias("chunks")))
    chunk = F.pmod(F.xxhash64("node", "bucket"), F.col("chunks"))
    placed = (keys.join(shared, "bucket").withColumn("side", chunk)
                  .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
                  .select("bucket", "node", "side", F.least("side", "other").alias("low"),
                          F.greatest("side", "other").alias("high")))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, int(placed.count()) // 50_000)
    found = stored(placed.join(classes.select("node", "label", "dim", "size", "vector"), "node")
                   .withColumn("part", F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(parts)).cast("int"))
                   .groupBy("part").applyInArrow(_pairs(hashing, threshold), "a long, b long, links long"),
                   "vector-links")
    lead = classes.select("node", "lead")
    links = found.where("b IS NOT NULL").join(lead.toDF("a", "lead_a"), "a").join(lead.toDF("b", "lead_b"), "b")
    reached = components(links.select(F.col("lead_a").alias("a"), F.col("lead_b").alias("b")))
    counted = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    known = (classes.join(counted, "node", "left")
                    .join(reached.withColumnRenamed("node", "lead"), "lead", "left")
                    .select("label", "dim", "vector",
                            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                            F.coalesce("component", "lead").alias("component_id")))
    linked = vectors.join(known, ["label", "dim", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return (linked.unionByName(alone)
                  .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
