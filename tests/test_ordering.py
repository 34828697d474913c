"""Ordered operators against brute force, with a key that holds a third or more of the rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlode.operators import ordering


def skewed(n=3000, hot=0.4, seed=3):
    rng = random.Random(seed)
    return [("hot" if rng.random() < hot else f"k{rng.randint(0, 40):02d}", rng.randint(0, 50), i,
             rng.randint(-5, 9)) for i in range(n)]


SCHEMA = "acct string, day int, id int, v long"


@pytest.fixture(scope="module")
def data(spark):
    rows = skewed() + [(None, 1, 100_000 + i, 1) for i in range(50)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(7)


@pytest.mark.parametrize("ranges", [None, 2, 13, 60])
def test_global_row_number(data, ranges):
    rows, df = data
    got = {r.id: r.n for r in ordering.global_row_number(df, ["acct", "day", "id"], "n",
                                                         ranges).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    assert got == {r[2]: i + 1 for i, r in enumerate(ordered)}


@pytest.mark.parametrize("hot_rows,ranges", [(10**6, None), (0, None), (100, 2), (100, 13), (0, 60)])
def test_running_sum(data, hot_rows, ranges):
    rows, df = data
    got = {r.id: r.total for r in ordering.running_sum(
        df, ["acct"], ["day", "id"], F.col("v"), "total", hot_rows, ranges).collect()}
    sums, want = defaultdict(int), {}
    for acct, day, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        sums[acct] += v
        want[i] = sums[acct]
    assert got == want


def test_running_sum_has_one_type(frame):
    df = frame([("a", 1, 5), ("a", 2, None)], "acct string, id int, v int").withColumn(
        "v", F.col("v").cast("decimal(18,2)"))
    cold, hot = (ordering.running_sum(df, ["acct"], ["id"], F.col("v"), "t", n, 2) for n in (10, 0))
    assert cold.schema["t"].dataType == hot.schema["t"].dataType
    assert sorted(cold.collect()) == sorted(hot.select(cold.columns).collect())


def test_hot_key_is_spread_over_ranges(data):
    _, df = data
    ranged = ordering.ordered_ranges(df, ["acct", "day", "id"], 20)
    largest = ranged.groupBy("__range").count().agg(F.max("count")).first()[0]
    assert largest < 0.2 * df.count()
    assert ranged.where("acct = 'hot'").select("__range").distinct().count() >= 5


def test_hot_key_check(data):
    _, df = data
    assert ordering.has_hot_key(df, ["acct"], 1000)
    assert not ordering.has_hot_key(df, ["acct"], 2000)
    assert not ordering.has_hot_key(df.limit(0), ["acct"], 0)


def test_repeated_order_values(frame):
    df = frame([(1, i) for i in range(500)] + [(2, i) for i in range(3)], "k int, i int")
    got = [r.n for r in ordering.global_row_number(df, ["k"], "n", 8).orderBy("n").collect()]
    assert got == list(range(1, 504))


def test_empty_input(frame):
    df = frame([], SCHEMA)
    assert ordering.surrogate_key(df, ["acct"], "sk").count() == 0
    assert ordering.running_sum(df, ["acct"], ["id"], F.col("v"), "t", 0, 4).count() == 0


def test_key_modes(frame):
    df = frame([("b",), ("a",)], "k string")
    keyed = ordering.surrogate_key(df, ["k"], "sk")
    assert {r.k: r.sk for r in keyed.collect()} == {"a": 1, "b": 2}
    assert keyed.schema["sk"].dataType.simpleString() == "bigint"
    stable = {r.k: r.sk for r in ordering.surrogate_key(df, ["k"], "sk", "hash").collect()}
    grown = ordering.surrogate_key(frame([("0",), ("a",), ("b",)], "k string"), ["k"], "sk", "hash")
    assert stable.items() <= {r.k: r.sk for r in grown.collect()}.items()
    with pytest.raises(ValueError):
        ordering.surrogate_key(df, ["k"], "sk", "guess")


def test_latest_per_key(data):
    rows, df = data
    got = {r.acct: r.id for r in ordering.latest_per_key(
        df, ["acct"], [F.desc("day"), F.desc("id")]).collect()}
    best = {}
    for acct, day, i, _ in rows:
        best[acct] = max(best.get(acct, (-1, -1)), (day, i))
    assert got == {a: b[1] for a, b in best.items()}


def test_flag_first(data):
    rows, df = data
    known = df.where("acct is not null")
    flagged = ordering.flag_first(known, ["acct"], ["day", "id"], "first").where("first").collect()
    best = {}
    for acct, day, i, _ in rows:
        if acct is not None:
            best[acct] = min(best.get(acct, (10**9, 0)), (day, i))
    assert {r.acct: r.id for r in flagged} == {a: b[1] for a, b in best.items()}
