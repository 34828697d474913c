"""The naming convention gives the pinned type of every column in the fixture list."""

import re
from pathlib import Path

import pytest
from pyspark.sql import types as T

from ledgerlode import schemas

SHORT = {"s": T.StringType(), "b": T.BooleanType(), "i": T.IntegerType(), "d": T.DateType(),
         "t": T.TimestampType(), "m": schemas.MONEY, "r": schemas.RATE,
         "decimal(5,1)": T.DecimalType(5, 1)}


def fixture_columns():
    text = (Path(__file__).resolve().parents[1] / "FIXTURES.md").read_text()
    section = text.split("## A.")[1].split("## B.")[0]
    for line in section.splitlines():
        cells = [c.strip() for c in line.strip("|").split("|")]
        if len(cells) < 3 or cells[0] in ("entity", "---"):
            continue
        plain = re.sub(r"\((?!\d)[^)]*\)", "", cells[2]).replace("**", "")
        for item in re.split(r",\s+", plain):
            name, kind = item.split()[:2]
            yield cells[0], name, kind.rstrip("?")


@pytest.mark.parametrize("entity,name,kind", list(fixture_columns()))
def test_pinned_type(entity, name, kind):
    assert schemas.pinned_type(name) == SHORT[kind]


def test_entity_schema_marks_the_key():
    schema = schemas.entity_schema(["fee_id", "fee_amount"], "fee_id")
    assert [f.nullable for f in schema] == [False, True]
    assert schema["fee_amount"].dataType == schemas.MONEY


def test_all_null_column_needs_no_inference(spark):
    schema = schemas.entity_schema(["employment_id", "employment_end_date"], "employment_id")
    assert spark.createDataFrame([("E1", None)], schema).first().employment_end_date is None
