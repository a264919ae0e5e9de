"""One presentation for both engines: 64-bit integers and rounded doubles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

DIGITS, HOUR_DIGITS = 6, 9
# Means of short decimals often lie on a rounding tie, give or take the last
# bit. A nudge far below the kept digits makes both engines round it upwards.
NUDGE = 5e-11


def digits_of(name: str) -> int:
    """Hours are multiples of 1/60 and their means need more digits to be free of ties."""
    return HOUR_DIGITS if "hours" in name else DIGITS


def rounded(name: str) -> str:
    """`round(name + NUDGE, digits)`, the same double, without a decimal for each value.

    The nearest whole multiple is certain unless the value is large or all but on a tie; only then Spark's `round` is asked.
    """
    digits = digits_of(name)
    value = f"({name} + {NUDGE}D)"
    scaled = f"({value} * 1e{digits}D)"
    certain = f"abs({value}) < 1e{11 - digits}D and abs({scaled} - rint({scaled})) < 0.499D"
    return f"case when {certain} then rint({scaled}) / 1e{digits}D else round({value}, {digits}) end"


def tidy(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        name = field.name
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            columns.append(f"{rounded(name)} + 0D AS {name}")
        elif isinstance(field.dataType, T.IntegralType):
            columns.append(f"cast({name} AS bigint) AS {name}")
        else:
            columns.append(name)
    return df.selectExpr(*columns)


def tidy_sql(sql: str, columns: str) -> str:
    """Outer select over `sql`; `columns` lists `name:kind`, kind i, d, or t (as is)."""
    selected = []
    for item in columns.split():
        name, kind = item.split(":")
        if kind == "d":
            selected.append(f"round(cast({name} as double) + {NUDGE}, {digits_of(name)}) + 0.0 as {name}")
        elif kind == "i":
            selected.append(f"cast({name} as bigint) as {name}")
        else:
            selected.append(name)
    return f"select {', '.join(selected)} from (\n{sql}\n) as answer"
