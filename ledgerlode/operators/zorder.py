"""Z-order clustering: rows near each other in several keys lie in one zone, whose min and max then prune on each key.

A key becomes its rank among a few bounds, the ranks' bits interleave to one number, and runs of that number with about
equal rows are zones. All of it is native expressions; only bounds and counts per cell, both of fixed size, pass
through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlode.functions.exprs import col

BITS = 5                       # of each key's rank
SAMPLE = 10_000                # rows that the bounds come from; they decide the balance only
ZONE = "zone"
_CELL = "__cell"


def range_bounds(df: DataFrame, keys: Sequence[str], bits: int = BITS, sample: int = SAMPLE) -> dict[str, list]:
    """For each key the values that cut a sample of the rows into ``2 ** bits`` parts of equal size."""
    columns = [col(k) for k in keys]
    rows = df.select(*columns).orderBy(F.xxhash64(*columns)).limit(sample).collect()
    out = {}
    for i, key in enumerate(keys):
        values = sorted(r[i] for r in rows if r[i] is not None)
        cuts = [values[len(values) * k >> bits] for k in range(1, 1 << bits)] if values else []
        out[key] = sorted(set(cuts))
    return out


def range_rank(column: Column, bounds: Sequence) -> Column:
    """How many of the ascending bounds are not above the value, by halving; null counts as below all."""
    def rank(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        middle = (lo + hi) // 2
        return F.when(column >= F.lit(bounds[middle]), rank(middle + 1, hi)).otherwise(rank(lo, middle))
    return rank(0, len(bounds))


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of the ranks in turn, the first key's bit lowest."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for i, r in enumerate(ranks):
            one = F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("long")
            out = out + F.shiftleft(one, bit * len(ranks) + i)
    return out


def zones(df: DataFrame, bounds: Mapping[str, Sequence], rows_per_zone: int, bits: int = BITS) -> DataFrame:
    """Add ``zone``: runs of cells along the Z curve with about ``rows_per_zone`` rows. A cell is never parted, so one
    that holds more is a zone of its own, which a writer may split into files."""
    cell = interleaved([range_rank(col(k), b) for k, b in bounds.items()], bits)
    cells = df.select(cell.alias(_CELL)).groupBy(_CELL).agg(F.count(F.lit(1)).alias("n")).collect()
    place, before = {}, 0
    for r in sorted(cells, key=lambda r: r[_CELL]):                  # at most 2 ** (bits * keys) cells
        place[r[_CELL]] = before // rows_per_zone
        before += r.n
    spark = df.sparkSession
    numbers = spark.createDataFrame(list(place.items()), f"{_CELL} long, {ZONE} long")
    return df.withColumn(_CELL, cell).join(F.broadcast(numbers), _CELL)


def clustered(df: DataFrame, keys: Sequence[str], rows_per_zone: int, bits: int = BITS,
              bounds: Mapping[str, Sequence] | None = None) -> DataFrame:
    """The rows with ``zone``, brought together by it and sorted along the Z curve, to be written partitioned by
    ``zone``. The rebalance splits a zone that is too large for one task."""
    placed = zones(df, bounds or range_bounds(df, keys, bits), rows_per_zone, bits)
    return placed.hint("rebalance", ZONE).sortWithinPartitions(ZONE, _CELL).drop(_CELL)


def zone_map(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and the least and greatest value of each key, per zone: what pruning by footers can use."""
    extremes = [f(col(k)).alias(f"{n}_{k}") for k in keys for f, n in ((F.min, "min"), (F.max, "max"))]
    return df.groupBy(ZONE).agg(F.count(F.lit(1)).alias("n_rows"), *extremes)


def zones_to_read(zone_map_: DataFrame, probes: Mapping[str, Sequence]) -> DataFrame:
    """For each probed value of each key, in how many zones, of how many, it can lie: ``key, probe, n_zones, total``."""
    hits = [F.count_if((F.col(f"min_{k}") <= F.lit(v)) & (F.lit(v) <= F.col(f"max_{k}"))).alias(f"h{i}_{j}")
            for i, (k, values) in enumerate(probes.items()) for j, v in enumerate(values)]
    counts = zone_map_.agg(F.count(F.lit(1)).alias("total"), *hits)
    rows = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(str(v)).alias("probe"), F.col(f"h{i}_{j}").alias("n_zones"))
                     for i, (k, values) in enumerate(probes.items()) for j, v in enumerate(values)])
    return counts.select(F.explode(rows).alias("r"), "total").select("r.key", "r.probe", "r.n_zones", "total")
