"""Schemas that grow without losing a value: widening along a lattice of types, and a test that a cast keeps a value.

Numbers widen from the smaller to the larger whole numbers, then to double (where every value of the whole type is one),
else to decimal. Dates widen to timestamps. Any other pair keeps the type that was there; values that it cannot hold
are misfits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlode.functions.exprs import col

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
#: Where whole numbers of 64 bits and fractions meet.
WIDEST = T.DecimalType(38, 18)


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number."""
    if kind in _DIGITS:
        return _DIGITS[kind], 0
    return (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else None


def wider(known: T.DataType, landed: T.DataType) -> T.DataType:
    """The type of a column that had one type so far and arrives with another."""
    if known == landed:
        return known
    if known in _WHOLE and landed in _WHOLE:
        return max(known, landed, key=_WHOLE.index)
    exact, floating = [k for k in (known, landed) if _digits(k)], [k for k in (known, landed)
                                                                   if isinstance(k, (T.FloatType, T.DoubleType))]
    if len(exact) == 2:
        (a, b), (c, d) = map(_digits, exact)
        before, after = max(a, c), max(b, d)
        return T.DecimalType(before + after, after) if before + after <= 38 else WIDEST
    if len(floating) == 2:
        return T.DoubleType()
    if len(exact) == len(floating) == 1:
        return T.DoubleType() if exact[0] in _WHOLE[:3] else WIDEST
    if {type(known), type(landed)} <= {T.DateType, T.TimestampType, T.TimestampNTZType} and isinstance(known, T.DateType):
        return landed
    return known


def widened(known: T.StructType | None, landed: T.StructType) -> T.StructType:
    """The columns of both, those known first, each in the wider type."""
    if known is None:
        return landed
    arriving = {f.name: f.dataType for f in landed}
    held = [T.StructField(f.name, wider(f.dataType, arriving.get(f.name, f.dataType)), True) for f in known]
    names = {f.name for f in held}
    return T.StructType([*held, *[T.StructField(f.name, f.dataType, True) for f in landed if f.name not in names]])


def keeps_value(column: Column, landed: T.DataType, target: T.DataType) -> Column:
    """Whether a cast gives a value that is the same: cast back it is equal, or, from text, it is the number or the
    instant that the text spells. Null stays null."""
    cast = column.try_cast(target)
    if isinstance(landed, T.StringType):
        if _digits(target):
            same = column.try_cast(WIDEST).eqNullSafe(cast.try_cast(WIDEST))
        elif isinstance(target, T.DateType):
            same = column.try_cast("timestamp_ntz").eqNullSafe(cast.cast("timestamp_ntz"))
        else:
            same = F.lit(True)
        return column.isNull() | (cast.isNotNull() & same)
    return column.isNull() | (cast.isNotNull() & cast.try_cast(landed).eqNullSafe(column))


def fit(df: DataFrame, target: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: rows whose shared columns keep their values in the target types, cast; and the other rows as
    they came, with the names of the columns that do not fit in ``misfits``."""
    wanted = {f.name: f.dataType for f in target}
    changing = [f for f in df.schema if f.name in wanted and wanted[f.name] != f.dataType]
    if not changing:
        return df, df.where(F.lit(False)).withColumn("misfits", F.lit(None).cast("array<string>"))
    misfits = F.filter(F.array(*[F.when(~keeps_value(col(f.name), f.dataType, wanted[f.name]), F.lit(f.name))
                                 for f in changing]), lambda name: name.isNotNull())
    marked = df.withColumn("misfits", misfits)
    names = {f.name for f in changing}
    good = marked.where(F.size("misfits") == 0).select(
        [col(c).try_cast(wanted[c]).alias(c) if c in names else col(c) for c in df.columns])
    return good, marked.where(F.size("misfits") > 0)


def cast_to(df: DataFrame, target: T.StructType) -> DataFrame:
    """The target's columns in its order, cast; missing ones null."""
    have = set(df.columns)
    return df.select([(col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target])
