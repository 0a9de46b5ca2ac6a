"""Surrogate keys (C15): md5 over a prefix and natural-key text.

Ids must be reproducible from the natural key alone, so a fact row can carry
its dimension id without joining the dimension (no shuffle, no broadcast).
The text of a double must look like Python's ``str(float)`` because existing
ids were made that way; Spark's ``cast(double as string)`` switches to
scientific notation outside [1e-3, 1e7), so doubles go through ``key_text``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAN_TEXT = "nan"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def double_text(c) -> Column:
    """Text of a double as Python's ``str`` prints it: the shortest digits that read back as the same value.

    Most values print alike in Spark (no exponent, at most 15 digits). For the others the first of
    the scientific texts of 15, 16 and 17 digits that reads back counts, printed with an exponent
    below 1e-4 and from 1e16 on. (Among subnormal values, and from 1e16 on where two texts are equally near, the
    last digits may differ from Python's; every text still reads back, so no two values share one.)
    """
    v = _col(c).cast("double")
    text = v.cast("string")
    tries = [F.format_string(f"%.{n}e", v) for n in (14, 15, 16)]
    sci = F.coalesce(*[F.when(t.try_cast("double") == v, t) for t in tries], F.lower(text))
    far = F.regexp_replace(sci, r"\.?0*e", "e")
    near = F.regexp_replace(sci.try_cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    return (F.when(v.isNull() | F.isnan(v), F.lit(NAN_TEXT))
            .when(~text.contains("E") & (F.length(text) <= 16), text)
            .when(F.abs(v) == float("inf"), F.when(v > 0, F.lit("inf")).otherwise(F.lit("-inf")))
            .when((F.abs(v) >= 1e16) | (F.abs(v) < 1e-4), far)
            .otherwise(near))


def key_text(c, dtype: T.DataType | None = None) -> Column:
    """Text of a key part, never NULL (``concat_ws`` would drop a NULL part)."""
    col = _col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return double_text(col)
    return F.coalesce(col.cast("string"), F.lit(NAN_TEXT))


def surrogate_key(prefix: str | None, *parts: Column) -> Column:
    """``md5(prefix_part1_part2...)``; parts must already be key text."""
    items = ([F.lit(prefix.rstrip("_"))] if prefix else []) + list(parts)
    return F.md5(F.concat_ws("_", *items))


def time_id(date_col, time_col) -> Column:
    """DimTime id: md5 of ``YYYY-MM-DDTHH:MM:SS`` (time already normalised)."""
    return F.md5(F.concat(F.date_format(_col(date_col), "yyyy-MM-dd"), F.lit("T"), _col(time_col)))
