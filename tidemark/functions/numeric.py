"""Numeric helpers: exact means, table decimals, unit scaling, bands."""

from __future__ import annotations

import decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import TABLE_DECIMAL

ColumnOrName = Column | str

# Exact, order-independent sums of double measures. A measure becomes an
# integer count of 1e-6 units (a long) and the longs are summed, so the
# result does not depend on partition order: a recomputed task yields the
# very same mean (stable under retries), and Spark and other engines agree.
# Each unit count is summed as two longs -- the high part (units >> 20) and
# the low 20 bits -- so a group holding a third of 1e12 rows cannot overflow
# (the low sum needs ~8.8e12 rows to overflow, the high one ~1e19 in value);
# the parts are combined once per group in decimal(38,0). Long additions stay
# on the primitive, codegen'd path; decimal sums above 18 digits run on java
# BigDecimal, about 10x slower.
EXACT_SCALE = 6
EXACT_TYPE = T.DecimalType(24, EXACT_SCALE)
UNITS_PER_ONE = 10**EXACT_SCALE
UNIT = decimal.Decimal(1).scaleb(-EXACT_SCALE)
SPLIT_BITS = 20


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact(c: ColumnOrName, dtype: T.DecimalType = EXACT_TYPE) -> Column:
    """Double -> decimal (null if it overflows)."""
    return _col(c).try_cast(dtype)


def exact_units(c: ColumnOrName) -> Column:
    """Double -> long count of 1e-6 units, or null where the value is not such a
    count: NaN, infinities, more than six decimals, beyond about 9.2e12."""
    col = _col(c)
    units = F.rint(col * F.lit(float(UNITS_PER_ONE)))
    whole = units / F.lit(float(UNITS_PER_ONE)) == col
    return F.when(whole, units.try_cast("long"))


def sum_units(units: ColumnOrName) -> Column:
    """Aggregate: exact sum of a long unit column as decimal(38,0)."""
    u = _col(units)
    high = F.sum(F.shiftright(u, SPLIT_BITS)).cast("decimal(38,0)")
    low = F.sum(u.bitwiseAND(F.lit((1 << SPLIT_BITS) - 1))).cast("decimal(38,0)")
    return (high * F.lit(1 << SPLIT_BITS) + low).cast("decimal(38,0)")


def units_to_double(total: ColumnOrName) -> Column:
    """A (decimal) sum of units back to the measure's scale, rounded once."""
    return (_col(total).cast("decimal(38,0)") * F.lit(UNIT)).cast("double")


def exact_mean(c: ColumnOrName) -> Column:
    """Mean of a double column. Where all values are counts of 1e-6 units, the
    result does not depend on row order: their exact sum, rounded to double
    once and divided by the number of values. Any other value makes it the
    plain ``avg`` of all of them, so none is left out. Null when there are none."""
    units = exact_units(c)
    exact_ = F.try_divide(units_to_double(sum_units(units)), F.count(units).cast("double"))
    return F.when(F.count(units) == F.count(_col(c)), exact_).otherwise(F.avg(_col(c)))


# What a stream keeps of one exact_mean, by place: names and types of the counts and sums in their order above.
MEAN_STATE = (("n_units", "long"), ("n", "long"), ("high", "long"), ("low", "long"), ("sum", "double"), ("count", "long"))


def mean_of_state(state: Column, prefix: str) -> Column:
    """The mean from the kept counts and sums (fields ``<prefix>_<name>`` of ``MEAN_STATE``)."""
    field = {name: state[f"{prefix}_{name}"] for name, _ in MEAN_STATE}
    total = field["high"].cast("decimal(38,0)") * F.lit(1 << SPLIT_BITS) + field["low"].cast("decimal(38,0)")
    exact_ = F.try_divide(units_to_double(total), field["n_units"].cast("double"))
    return F.when(field["n_units"] == field["n"], exact_).otherwise(F.try_divide(field["sum"], field["count"].cast("double")))


def mean_parts(c: ColumnOrName) -> Column:
    """Aggregate: what :func:`exact_mean` needs, as parts that can be merged (see :func:`merged_parts`)."""
    col, units = _col(c), exact_units(c)
    return F.struct(
        F.count(col).alias("n"),
        F.count(units).alias("n_units"),
        sum_units(units).alias("units"),
        F.sum(F.when(units.isNull(), col)).alias("other"),
    )


def merged_parts(parts: ColumnOrName) -> Column:
    """Aggregate: parts of one mean over the parts of others."""
    p = _col(parts)
    return F.struct(
        F.sum(p["n"]).alias("n"), F.sum(p["n_units"]).alias("n_units"),
        F.sum(p["units"]).cast("decimal(38,0)").alias("units"), F.sum(p["other"]).alias("other"),
    )


def mean_of_parts(parts: ColumnOrName) -> Column:
    """The mean: for values that are whole counts of 1e-6 units the very double that :func:`exact_mean` gives over
    the rows, however they were grouped in between."""
    p = _col(parts)
    exact_ = units_to_double(p["units"])
    total = F.when(p["n"] == p["n_units"], exact_).otherwise(F.coalesce(exact_, F.lit(0.0)) + p["other"])
    return F.try_divide(total, p["n"].cast("double"))


def mean_of_decimal(c: ColumnOrName) -> Column:
    """Mean of a decimal column returned as double (stats answers, X16)."""
    col = _col(c)
    return F.try_divide(F.sum(col).cast("double"), F.count(col).cast("double"))


def to_table_decimal(c: ColumnOrName, dtype: T.DecimalType = TABLE_DECIMAL) -> Column:
    """Double -> decimal(5,2), half-up on the printed value; null on overflow."""
    return _col(c).try_cast(dtype)


def scale(c: ColumnOrName, unit: str) -> Column:
    """Bytes -> KiB/MiB/GiB, dividing by 1024 once per step (P10)."""
    col = _col(c).cast("double")
    steps = {"B": 0, "KiB": 1, "MiB": 2, "GiB": 3}[unit]
    for _ in range(steps):
        col = col / F.lit(1024.0)
    return col


def band(c: ColumnOrName, steps: list[tuple[float | None, str]]) -> Column:
    """Threshold band (M9): each step holds from its value upward.

    ``steps`` is ordered, the first value is ``None`` (base colour).
    Null input gives null.
    """
    col = _col(c)
    base = steps[0][1]
    expr = F.lit(base)
    for value, colour in steps[1:]:
        expr = F.when(col >= F.lit(float(value)), F.lit(colour)).otherwise(expr)
    return F.when(col.isNull(), F.lit(None).cast("string")).otherwise(expr)
