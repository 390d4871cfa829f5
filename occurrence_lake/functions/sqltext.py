"""Helpers to write column expressions as Spark SQL text.

A wide expression built call by call from Python costs one driver round
trip per node; the same expression as text is parsed once on the JVM.
"""

from __future__ import annotations


def ref(c: str) -> str:
    """A column name as a quoted identifier; anything else is taken as SQL."""
    return f"`{c}`" if c.replace("_", "").isalnum() else f"({c})"


def dbl(v: float) -> str:
    """A DOUBLE literal (in Spark SQL a plain ``2.0`` is a DECIMAL)."""
    text = repr(float(v))
    if text in ("inf", "-inf", "nan"):
        return f"CAST('{text}' AS DOUBLE)"
    return text if "e" in text else text + "D"
