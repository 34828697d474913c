import datetime as dt

import pytest

from ledgerlode.operators import quality
from ledgerlode.schemas import DQ_SUMMARY_SCHEMA, RUN_LOG_SCHEMA


def test_profile(frame):
    df = frame([("a", 1), ("a", None), (None, 2), (None, 3), ("b", 4)], "id string, v int")
    row = quality.dq_profile(df, "t", ["id"], ["v", "absent"]).first()
    assert (row.total_rows, row.null_pk_rows, row.duplicate_pk_groups, row.passed) == (5, 2, 2, False)
    assert row.null_rates == {"v": pytest.approx(0.2)}


def test_profile_of_clean_empty_and_keyless_frames(frame):
    clean = quality.dq_profile(frame([("a",), ("b",)], "id string"), "t", ["id"]).first()
    assert clean.passed and clean.null_rates == {}
    empty = quality.dq_profile(frame([], "id string, v int"), "t", ["id"], ["v"]).first()
    assert (empty.total_rows, empty.passed, empty.null_rates) == (0, True, {"v": 0.0})
    keyless = quality.dq_profile(frame([("a",), ("a",)], "id string"), "t", []).first()
    assert (keyless.total_rows, keyless.duplicate_pk_groups, keyless.passed) == (2, 0, True)


def test_null_rates_against_limit(frame):
    df = frame([(None, "x")] + [("v", "x")] * 99, "a string, b string")
    rows = {r.column_name: (r.null_rows, r.passed) for r in quality.null_rates(df, ["a", "b"]).collect()}
    assert rows == {"a": (1, True), "b": (0, True)}
    strict = quality.null_rates(df, ["a"], limit=0.005).first()
    assert not strict.passed
    assert quality.null_rates(df.limit(0), ["a"]).first().null_rate == 0.0


def test_key_tests(frame):
    row = quality.key_tests(frame([(1,), (1,), (2,), (None,)], "sk long"), "sk").first()
    assert tuple(row) == ("sk", 4, 1, 1, False)


def test_orphans_threshold_is_inclusive(frame):
    fact = frame([(None, 1)] + [(1, 1)] * 999, "a long, b long")
    rows = {r.fk_column: r for r in quality.orphan_checks(
        fact, "F", [("a", "DimA"), ("b", "DimB")]).collect()}
    assert rows["a"].orphan_rows == 1 and rows["a"].passed
    assert rows["b"].orphan_rate == 0.0
    assert not quality.orphan_checks(fact, "F", [("a", "DimA")], limit=0.0005).first().passed
    assert quality.orphan_checks(fact.limit(0), "F", [("a", "DimA")]).first().passed


def test_missing_parents(frame):
    child = frame([("a",), ("zz",), ("zz",), (None,)], "k string")
    parent = frame([("a",), ("a",), ("b",)], "pk string")
    row = quality.missing_parents(child, parent, "k", "pk").first()
    assert (row.total_rows, row.null_key_rows, row.orphan_rows, row.orphan_keys) == (4, 1, 2, 1)


def test_gate_raises_and_passes(frame):
    checks = frame([(True,), (False,), (None,)], "passed boolean")
    row = quality.gate_result(checks).first()
    assert tuple(row) == (3, 2, False)
    with pytest.raises(quality.DataQualityError, match="2 of 3"):
        quality.dq_gate(checks)
    quality.dq_gate(checks.where("passed"))
    quality.dq_gate(checks.limit(0))


def test_summary_matches_table_schema(frame):
    fact = frame([(1,)], "a long")
    rows = quality.summary_rows(quality.orphan_checks(fact, "F", [("a", "DimA")]), "b1",
                                "2026-01-01 00:00:00")
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in DQ_SUMMARY_SCHEMA]


def test_run_log_with_all_null_columns(spark):
    start = dt.datetime(2026, 1, 1, 2, 0)
    log = quality.run_log(spark, [
        {"pipeline_name": "p", "notebook_name": "n", "layer": "L", "table_name": "t",
         "batch_id": "b", "status": "STARTED", "start_time": start, "end_time": start},
        {"pipeline_name": "p", "notebook_name": "n", "layer": "L", "table_name": "t",
         "batch_id": "b", "status": "SUCCESS", "start_time": start,
         "end_time": start + dt.timedelta(seconds=90), "rows_read": 5, "rows_written": 5}])
    assert log.schema == RUN_LOG_SCHEMA
    rows = {r.log_id: r for r in log.collect()}
    assert rows["n_t_b_STARTED"].rows_read is None
    assert rows["n_t_b_SUCCESS"].duration_seconds == 90.0


def test_gate_names_what_failed(frame):
    fact = frame([(1, None, "x"), (2, 5, None), (3, 6, None)], "id long, account_sk long, kind string")
    checks = quality.union_checks([quality.orphan_checks(fact, "Fact", [("account_sk", "DimAccount")], 0.5),
                                   quality.null_checks(fact, "Fact", ["kind", "id", "not_there"])])
    rows = {r.fk_column: r for r in checks.collect()}
    assert {k: (r.check_type, r.orphan_rows, r.passed) for k, r in rows.items()} == {
        "account_sk": ("REFERENTIAL_INTEGRITY", 1, True), "kind": ("NULL_RATE", 2, False), "id": ("NULL_RATE", 0, True)}
    with pytest.raises(quality.DataQualityError, match=r'1 of 3 checks failed: \[\{"check_type":"NULL_RATE".*"kind"'):
        quality.dq_gate(checks)


def test_has_repeats(frame):
    assert not quality.has_repeats(frame([(1, "a"), (1, "b"), (None, "a"), (1, None)], "k int, v string"))
    assert quality.has_repeats(frame([(1, None), (2, "b"), (1, None)], "k int, v string"))
    assert not quality.has_repeats(frame([], "k int, v string"))
