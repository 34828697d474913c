"""Merges, invariants and the point-in-time join on hand-written cases and against brute force."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlode.operators import pit, scd

KEY, TRACKED = ["id"], ["a", "b"]
SCHEMA = "id string, a string, b string"
T1, T2, T3 = "2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00"


def merge(current, source, ts, **kw):
    return scd.merge_scd2(current, source, KEY, TRACKED, ts, **kw)


def shape(df):
    return sorted((r.id, r.a, str(r.effective_start_date), str(r.effective_end_date),
                   r.is_current_flag) for r in df.collect())


def test_a_b_a_history(frame):
    v1 = merge(None, frame([("1", "A", "x"), ("2", "K", "x")], SCHEMA), T1)
    v2 = merge(v1, frame([("1", "B", "x"), ("3", "N", "x")], SCHEMA), T2)
    v3 = merge(v2, frame([("1", "A", "x")], SCHEMA), T3)
    assert shape(v3) == [
        ("1", "A", T1, T2, False), ("1", "A", T3, "None", True), ("1", "B", T2, T3, False),
        ("2", "K", T1, "None", True), ("3", "N", T2, "None", True)]
    assert tuple(scd.scd2_violations(v3, KEY).first()) == (3, 0, 0, 0, 0)


def test_rerun_changes_nothing(frame):
    source = frame([("1", "B", "x"), ("3", "N", None)], SCHEMA)
    v1 = merge(None, frame([("1", "A", "x")], SCHEMA), T1)
    once = merge(v1, source, T2)
    twice = merge(once, source, T3)
    assert shape(once) == shape(twice)
    counts = scd.scd2_change_counts(merge(once, source, T3, with_action=True))
    assert {r.action: r.n_rows for r in counts.collect()} == {"keep": 3}


def test_value_moving_between_nullable_columns(frame):
    v1 = merge(None, frame([("1", "v", None)], SCHEMA), T1)
    moved = frame([("1", None, "v")], SCHEMA)
    assert merge(v1, moved, T2).count() == 1
    strict = merge(None, frame([("1", "v", None)], SCHEMA), T1, digest_mode="strict")
    assert merge(strict, moved, T2, digest_mode="strict").count() == 2


def test_duplicate_source_keys(frame):
    twice = frame([("1", "A", "x"), ("1", "B", "x")], SCHEMA)
    with pytest.raises(PySparkException, match="duplicate key"):
        merge(None, twice, T1).collect()
    kept = merge(None, twice, T1, on_duplicate="latest", newest_first=[F.desc("a")])
    assert [r.a for r in kept.collect()] == ["B"]
    with pytest.raises(ValueError):
        merge(None, twice, T1, on_duplicate="any")


def test_new_column_in_second_batch(frame):
    v1 = merge(None, frame([("1", "A", "x"), ("2", "B", "x")], SCHEMA), T1)
    wider = frame([("1", "Z", "x", "new")], SCHEMA + ", c string")
    rows = {(r.id, r.a): r.c for r in merge(v1, wider, T2).collect()}
    assert rows == {("1", "A"): None, ("1", "Z"): "new", ("2", "B"): None}


def test_first_start(frame):
    v1 = merge(None, frame([("1", "A", "x")], SCHEMA), T1, first_start="1900-01-01 00:00:00")
    assert v1.first().effective_start_date == dt.datetime(1900, 1, 1)


def test_scd1(frame):
    current = frame([("1", "A", "x"), ("2", "B", "x")], SCHEMA)
    merged = scd.merge_scd1(current, frame([("2", "C", None), ("3", "D", "y")], SCHEMA), KEY)
    assert sorted(map(tuple, merged.collect())) == [
        ("1", "A", "x"), ("2", "C", None), ("3", "D", "y")]
    narrow = scd.merge_scd1(current, frame([("2", "C")], "id string, a string"), KEY)
    assert sorted((r.id, r.a, r.b) for r in narrow.collect()) == [("1", "A", "x"), ("2", "C", "x")]
    assert scd.merge_scd1(None, current, KEY).count() == 2
    with pytest.raises(PySparkException, match="duplicate key"):
        scd.merge_scd1(None, current.union(current), KEY).collect()


VERSION = "id string, effective_start_date timestamp, effective_end_date timestamp, " \
          "is_current_flag boolean"


def day(n):
    return None if n is None else dt.datetime(2026, 1, n)


@pytest.mark.parametrize("versions,expected", [
    ([(1, 3, False), (3, None, True)], (1, 0, 0, 0, 0)),
    ([(1, None, True), (3, None, True)], (1, 1, 1, 0, 0)),
    ([(1, 3, False), (4, None, True)], (1, 0, 1, 0, 0)),
    ([(1, 5, False), (3, None, True)], (1, 0, 1, 0, 0)),
    ([(1, 3, True), (3, None, True)], (1, 1, 0, 1, 0)),
    ([(3, 3, False), (3, None, True)], (1, 0, 1, 0, 1)),
])
def test_violations(frame, versions, expected):
    df = frame([("k", day(s), day(e), c) for s, e, c in versions], VERSION)
    assert tuple(scd.scd2_violations(df, KEY).first()) == expected


PIT_EVENT, PIT_VERSION = "id string, at timestamp, n int", \
    "id string, start timestamp, stop timestamp, grade string"


@pytest.mark.parametrize("strategy,hot_rows", [("join", 0), ("scan", 0), ("scan", 99), ("auto", 0)])
def test_pit_boundaries(frame, strategy, hot_rows):
    versions = frame([("1", day(2), day(4), "A"), ("1", day(4), day(6), "B"),
                      ("2", day(1), None, "C"), (None, day(1), None, "X")], PIT_VERSION)
    events = frame([("1", day(1), 1), ("1", day(2), 2), ("1", day(4), 3), ("1", day(6), 4),
                    ("2", day(9), 5), ("3", day(9), 6), (None, day(9), 7), ("2", None, 8)], PIT_EVENT)
    joined = pit.pit_join(events, versions, KEY, "at", "start", "stop", ["grade"], strategy,
                          hot_rows)
    assert joined.columns == ["id", "at", "n", "grade"]
    assert {r.n: r.grade for r in joined.collect()} == {
        1: None, 2: "A", 3: "B", 4: None, 5: "C", 6: None, 7: None, 8: None}


def test_pit_strategies_agree_on_a_hot_key(spark):
    rng = random.Random(7)
    versions, events = [], []
    for key in ["hot"] + [f"k{i}" for i in range(30)]:
        cuts = sorted(rng.sample(range(1, 5000), 300 if key == "hot" else 5))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:] + [None])):
            if rng.random() < 0.9:      # leave gaps
                versions.append((key, a, b, f"{key}-{i}"))
    for i in range(4000):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 35)}"
        events.append((key, rng.randint(0, 5200), i))
    v = spark.createDataFrame(versions, "id string, start int, stop int, grade string")
    e = spark.createDataFrame(events, "id string, at int, n int").repartition(5)
    results = []
    for strategy, hot_rows, ranges in (("join", 0, None), ("scan", 10**6, None), ("scan", 50, 2),
                                       ("scan", 0, 25)):
        joined = pit.pit_join(e, v, KEY, "at", "start", "stop", ["grade"], strategy, hot_rows, ranges)
        results.append({r.n: r.grade for r in joined.collect()})
    brute = {}
    for key, at, n in events:
        hits = [g for k, a, b, g in versions if k == key and a <= at and (b is None or at < b)]
        brute[n] = hits[0] if hits else None
    assert all(r == brute for r in results)


def test_auto_scans_when_a_key_has_many_versions(spark):
    many = spark.range(200).selectExpr("'k' as id", "id as start", "id + 1 as stop", "'g' as grade")
    assert not pit._few_versions(many.select("id"), KEY)
    assert pit._few_versions(many.where("start < 50").select("id"), KEY)


@pytest.mark.parametrize("strategy,hot_rows,ranges", [
    ("join", 0, None), ("scan", 10**6, None), ("scan", 0, 3), ("auto", 0, None)])
def test_pit_overlaps(frame, strategy, hot_rows, ranges):
    """The latest start decides, and a version that ended gives no way to an older one still open."""
    versions = frame([("1", day(1), day(9), "A"), ("1", day(3), day(5), "B"), ("2", day(2), None, "C"),
                      ("2", day(2), None, "D"), ("3", None, None, "E")], PIT_VERSION)
    events = frame([("1", day(n), n) for n in range(1, 8)] + [("2", day(4), 20), ("3", day(4), 30)], PIT_EVENT)
    joined = pit.pit_join(events, versions, KEY, "at", "start", "stop", ["grade"], strategy, hot_rows, ranges)
    got = {r.n: r.grade for r in joined.collect()}
    tied = got.pop(20)
    assert got == {1: "A", 2: "A", 3: "B", 4: "B", 5: None, 6: None, 7: None, 30: None}
    largest = versions.where("id = '2'").orderBy(F.desc(F.xxhash64("id", "start", "stop", "grade"))).first()
    assert tied == largest.grade


def test_unknown_strategy(frame):
    df = frame([], PIT_EVENT)
    with pytest.raises(ValueError):
        pit.pit_join(df, frame([], PIT_VERSION), KEY, "at", "start", "stop", [], "guess")
