"""Column-expression builders.

All of these return ``Column`` objects made of built-in Spark functions, so
they stay inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's str.strip() removes (str.isspace).
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
              + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Strip leading/trailing whitespace (the Unicode set ``str.strip`` uses),
    with ``btrim`` over a character set: no regular expression per value."""
    return F.btrim(col_(c), F.lit(WHITESPACE))


def to_double(c: str | Column) -> Column:
    """Text to double; unparsable text becomes null (never raises)."""
    return F.expr(f"try_cast({_sql_ref(c)} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")


def _sql_ref(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def encode_map(c: str | Column, mapping: Mapping[str, int], on_unknown: str = "fail",
               name: str | None = None, dtype: str = "tinyint") -> Column:
    """Map category text to a small integer.

    ``on_unknown="fail"`` raises at run time on an unmapped value or a null,
    the way casting a NaN to int8 fails; ``"null"`` yields null instead.
    """
    src = col_(c)
    label = name or (c if isinstance(c, str) else "value")
    expr = None
    for key, val in mapping.items():
        expr = (F.when(src == F.lit(key), F.lit(val)) if expr is None
                else expr.when(src == F.lit(key), F.lit(val)))
    if on_unknown == "fail":
        err = F.raise_error(F.concat(F.lit(f"unmapped value in {label}: "),
                                     F.coalesce(src.cast("string"), F.lit("NULL"))))
        expr = expr.otherwise(err)
    elif on_unknown != "null":
        raise ValueError("on_unknown must be 'fail' or 'null'")
    return expr.cast(dtype)


def indicator(c: str | Column, value, dtype: str = "tinyint") -> Column:
    """1 when the column equals ``value``, else 0 (null counts as 0)."""
    return F.coalesce((col_(c) == F.lit(value)).cast(dtype), F.lit(0).cast(dtype))


def bucketize(c: str | Column, upper_edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins: ``x <= e1 -> l1``, ..., else the last label.

    Null falls through to the last label (a failed comparison is false).
    """
    if len(labels) != len(upper_edges) + 1:
        raise ValueError("need one label more than edges")
    src = col_(c)
    expr = F.when(src <= F.lit(upper_edges[0]), F.lit(labels[0]))
    for edge, label in zip(upper_edges[1:], labels[1:-1]):
        expr = expr.when(src <= F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def round_half_even(c: str | Column, scale: int) -> Column:
    """numpy-style rounding: ``rint(x * 10^s) / 10^s`` (ties to even)."""
    factor = float(10 ** scale)
    return F.rint(col_(c) * F.lit(factor)) / F.lit(factor)


def safe_ratio(num: str | Column, den: str | Column, fallback: str | Column,
               scale: int | None = None) -> Column:
    """``den > 0 ? num / den : fallback``, optionally rounded half-even."""
    d = col_(den)
    value = F.when(d > 0, col_(num) / d).otherwise(col_(fallback))
    return round_half_even(value, scale) if scale is not None else value


def row_sum(cols: Iterable[str | Column], null_as_zero: bool = True) -> Column:
    parts = [F.coalesce(col_(c), F.lit(0)) if null_as_zero else col_(c) for c in cols]
    return reduce(lambda a, b: a + b, parts)


def risk_level(p: str | Column, bands=None, top: str | None = None) -> Column:
    """Probability to a risk label using strict upper bounds (``p < bound``)."""
    from ..schemas import RISK_BANDS, RISK_TOP
    bands = bands or RISK_BANDS
    top = top or RISK_TOP
    src = col_(p)
    expr = F.when(src < F.lit(bands[0][0]), F.lit(bands[0][1]))
    for bound, label in bands[1:]:
        expr = expr.when(src < F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(top))


def at_least(p: str | Column, threshold: float, dtype: str = "tinyint") -> Column:
    return (col_(p) >= F.lit(threshold)).cast(dtype)


def md5_order_key(seed: int, id_col: str | Column) -> Column:
    """Repeatable, layout-independent pseudo-random key: ``md5(seed:id)``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col_(id_col).cast("string")))


def hash_unit(seed: int, id_col: str | Column, salt: str = "") -> Column:
    """A uniform number in [0, 1) from ``md5(seed:salt:id)`` (first 13 hex digits)."""
    h = F.md5(F.concat(F.lit(f"{seed}:{salt}:"), col_(id_col).cast("string")))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))
