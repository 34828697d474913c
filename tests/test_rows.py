import datetime as dt

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F, types as T

from ledgerlode.functions.exprs import padded_id, row_digest, safe_divide
from ledgerlode.operators import rows
from ledgerlode.schemas import AUDIT_COLUMNS


def test_compat_digest_collides_and_strict_does_not(frame):
    df = frame([("a", None), (None, "a"), ("a", "a")], "x string, y string")
    compat = [r[0] for r in df.select(row_digest(["x", "y"])).collect()]
    strict = [r[0] for r in df.select(row_digest(["x", "y"], "strict")).collect()]
    assert compat[0] == compat[1] != compat[2]
    assert len(set(strict)) == 3


def test_strict_digest_survives_separator_in_value(frame):
    df = frame([("a||b", "c"), ("a", "b||c")], "x string, y string")
    assert df.select(row_digest(["x", "y"])).distinct().count() == 1
    assert df.select(row_digest(["x", "y"], "strict")).distinct().count() == 2


def test_unknown_digest_mode(spark):
    with pytest.raises(ValueError):
        row_digest(["x"], "loose")


def test_audit_columns_in_order_and_removable(frame):
    df = frame([("1", "a")], "id string, v string")
    stamped = rows.stamp_audit(df, "CORE", "b1", "p", "2026-01-01 00:00:00", "f")
    assert stamped.columns == ["id", "v", *AUDIT_COLUMNS]
    assert stamped.first().load_timestamp == dt.datetime(2026, 1, 1)
    assert rows.drop_audit(stamped).columns == ["id", "v"]
    again = rows.stamp_audit(stamped, "CORE", "b2", "p", "2026-01-02 00:00:00", "f")
    assert again.first().record_hash == stamped.first().record_hash


def test_enforce_schema_raises_or_quarantines(frame):
    df = frame([("1", "2.50", "x"), ("2", "two", "y"), (None, None, "z")],
               "id string, amount string, extra string")
    target = T.StructType([T.StructField("amount", T.DecimalType(18, 2)),
                           T.StructField("id", T.LongType()), T.StructField("absent", T.DateType())])
    with pytest.raises(NumberFormatException):
        rows.enforce_schema(df, target).collect()
    good, bad = rows.enforce_schema(df, target, "quarantine")
    assert sorted(r.extra for r in good.collect()) == ["x", "z"]
    assert good.schema["amount"].dataType == T.DecimalType(18, 2)
    assert [tuple(r) for r in bad.collect()] == [("2", "two", "y")]
    with pytest.raises(ValueError):
        rows.enforce_schema(df, target, "ignore")


def test_cleanse_trims_dedups_and_drops_missing_keys(frame):
    df = frame([(" a ", "x"), ("a", "x "), (None, "x")], "id string, v string")
    stamped = rows.stamp_audit(df, "CORE", "b1", "p", "2026-01-01 00:00:00", "f")
    clean = rows.cleanse(stamped, ["id"], upper=["v"])
    assert [tuple(r) for r in clean.collect()] == [("a", "X")]


def test_split_quarantine_composite_key(frame):
    df = frame([("a", "b"), ("a", None), (None, None)], "x string, y string")
    good, bad = rows.split_quarantine(df, ["x", "y"])
    assert good.count() == 1 and bad.count() == 2
    good, bad = rows.split_quarantine(df, [])
    assert good.count() == 3 and bad.count() == 0


def test_dedup_by_hash_without_hash_column(frame):
    df = frame([("a",), ("a",)], "x string")
    assert rows.dedup_by_hash(df).count() == 2


def test_union_batches_with_new_column(frame):
    first = frame([("a", 1)], "k string, v int")
    second = frame([("b", 2, "n")], "k string, v int, w string")
    assert sorted(map(tuple, rows.union_batches(first, second).collect())) == [
        ("a", 1, None), ("b", 2, "n")]


def test_channel_split_is_complete(frame):
    df = frame([("m",), ("w",), (None,)], "c string")
    mobile, web = rows.split_channel(df, "c", "m")
    assert mobile.count() == 1 and web.count() == 2


def test_masks(frame):
    df = frame([("AB123456C", "card-1", "x1", 5)], "ni string, card string, shape string, n int")
    row = rows.mask_columns(df, {"ni": "tail", "card": "token", "shape": "shape", "n": "null"}).first()
    assert row.ni == "****456C" and len(row.card) == 32 and row.shape == "xn" and row.n is None


@pytest.mark.parametrize("a,b,expected", [(1, 2, 0.5), (1, 0, 0.0), (1, None, 0.0), (None, 2, None)])
def test_safe_divide(frame, a, b, expected):
    df = frame([(a, b)], "a int, b int")
    assert df.select(safe_divide(F.col("a"), F.col("b"))).first()[0] == expected


def test_padded_id_keeps_long_numbers(frame):
    df = frame([(7,), (123456789,)], "n long")
    assert [r[0] for r in df.select(padded_id("X", F.col("n"), 4)).collect()] == [
        "X0007", "X123456789"]


def test_entitlement_without_rows_hides_everything(frame):
    df = frame([("a", 1)], "k string, v int")
    allowed = frame([("a", "RM")], "k string, role string")
    assert rows.entitled_rows(df, allowed, ["k"], "role", "RM").count() == 1
    assert rows.entitled_rows(df, allowed, ["k"], "role", "AGENT").count() == 0
