"""Column expressions shared by the operators: digests, safe division, calendar keys, masking."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F


def col(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_timestamp(value: str | dt.datetime | Column) -> Column:
    """A timestamp given by the caller. Columns pass through, so NTZ frames can stay NTZ."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")


def row_digest(columns: Iterable[str], mode: str = "compat") -> Column:
    """SHA-256 over columns as text.

    ``compat`` joins with ``||`` and skips NULLs, so a value moving between two nullable columns keeps
    its digest. ``strict`` writes every value as ``<length>:<text>`` and NULL as ``-``, which no two
    different rows share.
    """
    texts = [col(c).cast("string") for c in columns]
    if mode == "strict":
        texts = [
            F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-"))
            for t in texts
        ]
    elif mode != "compat":
        raise ValueError(f"unknown digest mode: {mode!r}")
    return F.sha2(F.concat_ws("||", *texts), 256)


def any_null(columns: Iterable[str]) -> Column:
    """True when at least one of the columns is NULL; false for an empty list."""
    return reduce(or_, [col(c).isNull() for c in columns], F.lit(False))


def all_present(columns: Iterable[str]) -> Column:
    return reduce(and_, [col(c).isNotNull() for c in columns], F.lit(True))


def safe_divide(numerator: Column, denominator: Column, default: float = 0) -> Column:
    """Ratio that gives ``default`` when the denominator is zero or NULL."""
    blank = denominator.isNull() | (denominator == 0)
    return F.when(blank, F.lit(default).cast("double")).otherwise(
        numerator.cast("double") / denominator.cast("double")
    )


def date_key(date: Column) -> Column:
    """Calendar key: the date as an integer yyyymmdd."""
    return F.date_format(date, "yyyyMMdd").cast("int")


def padded_id(prefix: str, number: Column, width: int = 7) -> Column:
    """Natural key such as CUST0000001. A number longer than ``width`` keeps all its digits."""
    text = number.cast("string")
    pad = F.repeat(F.lit("0"), F.greatest(F.lit(width) - F.length(text), F.lit(0)))
    return F.concat(F.lit(prefix), pad, text)


def token(column: Column, length: int = 32) -> Column:
    """Irreversible token: leading hex digits of the SHA-256."""
    return F.substring(F.sha2(column.cast("string"), 256), 1, length)


def tail_mask(column: Column, visible: int = 4, fill: str = "*", width: int = 4) -> Column:
    """Keep the last characters only."""
    return F.concat(F.lit(fill * width), F.right(column, F.lit(visible)))
