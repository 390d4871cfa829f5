"""Scalar expressions of the refinement and serving steps (EXP-3, EXP-7, EXP-8).

Each raises through ``raise_error`` where the reference aborts, so the
behaviour does not depend on the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def make_date_strict(year, month, day, strict: bool = True) -> Column:
    """EXP-3: a date from parts.  Any NULL part -> NULL; an impossible date
    (30 February) aborts the job, as the reference's ``MAKE_DATE`` does, or
    is NULL with ``strict=False``."""
    y, m, d = _col(year), _col(month), _col(day)
    if not strict:   # through text, which gives NULL whatever the session's ANSI setting
        text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))
        whole = y.isNotNull() & m.isNotNull() & d.isNotNull()
        return F.when(whole, F.call_function("try_to_date", text, F.lit("yyyy-MM-dd")))
    made = F.make_date(y.cast("int"), m.cast("int"), d.cast("int"))
    return (F.when(y.isNull() | m.isNull() | d.isNull(), F.lit(None).cast("date"))
            .when(made.isNull(), F.raise_error(F.concat(
                F.lit("invalid date from parts: "), F.concat_ws("-", y, m, d))).cast("date"))
            .otherwise(made))


def narrow_to_int(c, what: str = "key") -> Column:
    """EXP-7: BIGINT -> INTEGER; NULL or out of range aborts (``int(None)``
    and a PostgreSQL INTEGER column both fail there)."""
    c = _col(c)
    return (F.when(c.isNull(), F.raise_error(F.lit(f"NULL {what} cannot be narrowed to INTEGER")).cast("int"))
            .when((c < F.lit(INT_MIN)) | (c > F.lit(INT_MAX)),
                  F.raise_error(F.concat(F.lit(f"CAST_OVERFLOW: {what} "), c.cast("string"),
                                         F.lit(" does not fit INTEGER"))).cast("int"))
            .otherwise(c.cast("int")))


def zero_as_null(c) -> Column:
    """EXP-8: Python truthiness on a float: 0.0 and -0.0 become NULL, NaN and
    every other value pass unchanged."""
    return F.nullif(_col(c).cast("double"), F.lit(0.0))
