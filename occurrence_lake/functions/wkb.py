"""Well-known-binary (WKB) points and multipoints as Spark SQL expressions.

Spark 4.1 has no point constructor and cannot write a GEOMETRY column to
Parquet, so geometries are stored as ``BinaryType`` holding ISO WKB, little
endian (byte order 1), exactly the bytes a PostGIS/DuckDB ``ST_AsWKB`` emits:

* Point:      01 | 01000000 | x: float64 LE | y: float64 LE          (21 bytes)
* MultiPoint: 01 | 04000000 | n: uint32 LE  | n points as above      (9 + 21 n)

The IEEE-754 bit pattern of a double is computed with plain arithmetic
(``log2``/``power``/shifts).  The expressions are deterministic and run
inside whole-stage codegen: no Python worker, no reflection, and the
optimizer may still push filters below them.

Each expression is assembled as SQL text and handed to Spark once
(``F.expr``): one parse on the JVM instead of hundreds of driver round
trips to build the same tree.  Arguments are column names or SQL
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occurrence_lake.functions.sqltext import dbl as _d
from occurrence_lake.functions.sqltext import ref as _ref
from occurrence_lake.schema import SRID

# Fixed values of the WKB format.
POINT_HEADER_HEX = "0101000000"       # little endian, type 1 (Point)
MULTIPOINT_HEADER_HEX = "0104000000"  # little endian, type 4 (MultiPoint)
POINT_BYTES = 21
POINT_HEADER_BYTES = 5
POINT_HEADERS_HEX = ("0101000000", "0000000001")   # byte order and type, little and big endian
MULTIPOINT_HEADER_BYTES = 9

_NAN_BITS = 0x7FF8000000000000
_INF_BITS = 0x7FF0000000000000


# ---------------------------------------------------------------------------
# double <-> IEEE-754 bits
# ---------------------------------------------------------------------------
def _exponent_guess_sql(a: str) -> str:
    # 2^e0 may be one off next to a power of two; clamped to the normal range
    return f"least(greatest(floor(log2({a})), -1022L), 1023L)"


def _bits_from_parts_sql(x: str, a: str, e0: str, m0: str) -> str:
    """Bits of ``x`` given a = |x|, the exponent guess e0 and m0 = a / 2^e0
    (exact: a power-of-two scaling), so the correction below is exact too."""
    e = f"({e0} + CASE WHEN {m0} >= 2.0D THEN 1L WHEN {m0} < 1.0D THEN -1L ELSE 0L END)"
    m = f"(CASE WHEN {m0} >= 2.0D THEN {m0} * 0.5D WHEN {m0} < 1.0D THEN {m0} * 2.0D ELSE {m0} END)"
    normal = f"(shiftleft({e} + 1023L, 52) | floor(({m} - 1.0D) * {_d(2.0 ** 52)}))"
    # zero and subnormals: the mantissa alone, scaled exactly
    tiny = f"floor({a} * {_d(2.0 ** 1022)} * {_d(2.0 ** 52)})"
    magnitude = (f"CASE WHEN {a} >= {_d(2.0 ** -1022)} AND {a} < {_d(float('inf'))} THEN {normal} "
                 f"WHEN isnan({x}) THEN {_NAN_BITS}L WHEN {a} = {_d(float('inf'))} THEN {_INF_BITS}L "
                 f"ELSE {tiny} END")
    # -0.0 equals 0.0 and Spark's atan2 folds the sign, so read the text.
    negative = f"({x} < 0.0D OR ({x} = 0.0D AND startswith(CAST({x} AS STRING), '-')))"
    return f"(({magnitude}) | CASE WHEN {negative} THEN shiftleft(1L, 63) ELSE 0L END)"


def _bits_to_double_sql(hi32: str, lo32: str) -> str:
    sign = f"(shiftright({hi32}, 31) & 1L)"
    exp = f"(shiftright({hi32}, 20) & 2047L)"
    mant = f"CAST(({hi32} & 1048575L) * 4294967296L + {lo32} AS DOUBLE)"
    magnitude = (f"CASE WHEN {exp} = 0L THEN {mant} * {_d(2.0 ** -1074)} "
                 f"WHEN {exp} = 2047L THEN CASE WHEN {mant} = 0.0D THEN {_d(float('inf'))} "
                 f"ELSE {_d(float('nan'))} END "
                 f"ELSE (1.0D + {mant} / {_d(2.0 ** 52)}) * power(2.0D, CAST({exp} - 1023L AS DOUBLE)) END")
    # (1 - 2 sign) * magnitude keeps -0.0, -inf and NaN right, with one copy
    # of the magnitude expression in the generated code.
    return f"(CAST(1L - 2L * {sign} AS DOUBLE) * ({magnitude}))"


# ---------------------------------------------------------------------------
# byte-order helpers
# ---------------------------------------------------------------------------
def _reverse_bytes_sql(v: str, nbytes: int) -> str:
    parts = [f"shiftleft(shiftright({v}, {8 * i}) & 255L, {8 * (nbytes - 1 - i)})" for i in range(nbytes)]
    return "(" + " | ".join(parts) + ")"


def le_hex64_sql(bits: str) -> str:
    """16 hex digits of a BIGINT in little-endian byte order."""
    return f"lpad(hex({_reverse_bytes_sql(bits, 8)}), 16, '0')"


def le_hex32_sql(n: str) -> str:
    """8 hex digits of a non-negative 32-bit count in little-endian byte order."""
    return f"lpad(hex({_reverse_bytes_sql(f'CAST({n} AS BIGINT)', 4)}), 8, '0')"


def _half_sql(h: str, pos: int) -> str:
    """4 bytes of a hex-encoded WKB as a BIGINT, in file byte order."""
    return f"CAST(conv(substring({h}, {pos}, 8), 16, 10) AS BIGINT)"


def _hi_lo_sql(le: str, a: str, b: str) -> tuple[str, str]:
    """High and low 32 bits of a double stored as halves ``a`` then ``b``:
    swapped and byte-reversed (arithmetic, no string work) when the value
    is little endian."""
    return (f"CASE WHEN {le} THEN {_reverse_bytes_sql(b, 4)} ELSE {a} END",
            f"CASE WHEN {le} THEN {_reverse_bytes_sql(a, 4)} ELSE {b} END")


def _u32_sql(h: str, pos: int) -> str:
    """A 4-byte unsigned field of a hex-encoded WKB, honouring its byte-order flag."""
    return (f"CASE WHEN substring({h}, 1, 2) = '01' THEN {_reverse_bytes_sql(_half_sql(h, pos), 4)} "
            f"ELSE {_half_sql(h, pos)} END")


# ---------------------------------------------------------------------------
# EXP-4 / EXP-5: encode.  Staged forms.  One expression for a whole point grows past what the code
# generator compiles into one method (Spark then falls back to the slow
# interpreted path).  The staged forms compute each intermediate once, in
# its own projection; since every intermediate is used several times,
# Catalyst keeps the projections apart, and each stays small.
# ---------------------------------------------------------------------------
def with_double_bits(df: DataFrame, outputs: dict[str, str], keep_temps: bool = False) -> DataFrame:
    """Add ``{out: bits of input}`` columns (BIGINT IEEE-754 patterns)."""
    t = {o: (f"__{o}_a", f"__{o}_e0", f"__{o}_m0") for o in outputs}
    s1 = df.selectExpr("*", *[e for o, c in outputs.items() for e in (
        f"abs({_ref(c)}) AS `{t[o][0]}`", f"{_exponent_guess_sql(f'abs({_ref(c)})')} AS `{t[o][1]}`")])
    s2 = s1.selectExpr("*", *[f"(`{t[o][0]}` / power(2.0D, `{t[o][1]}`)) AS `{t[o][2]}`" for o in outputs])
    s3 = s2.selectExpr("*", *[f"{_bits_from_parts_sql(_ref(c), *[f'`{n}`' for n in t[o]])} AS `{o}`"
                              for o, c in outputs.items()])
    return s3 if keep_temps else s3.drop(*[n for names in t.values() for n in names])


def with_point_wkb(df: DataFrame, lon: str, lat: str, out: str = "coordinates") -> DataFrame:
    """Add ``out``: WKB Point of (lon, lat); NULL if either is NULL.

    Filter on ``lon``/``lat``, not on ``out``, in the same plan: a predicate
    on ``out`` is pushed below these projections with the whole encoding
    substituted into it."""
    bx, by = f"__{out}_bx", f"__{out}_by"
    staged = with_double_bits(df, {bx: lon, by: lat}, keep_temps=True)   # the select below drops them
    return staged.selectExpr(
        *[f"`{c}`" for c in df.columns if c != out],
        f"unhex(concat('{POINT_HEADER_HEX}', {le_hex64_sql(f'`{bx}`')}, {le_hex64_sql(f'`{by}`')})) AS `{out}`")


def multipoint_wkb(n_points: str, body: str) -> Column:
    """MultiPoint from a point count and the concatenated point WKBs.

    ``body`` NULL (a group without a non-NULL point) gives the empty
    MultiPoint ``010400000000000000``.
    """
    return F.expr(f"concat(unhex(concat('{MULTIPOINT_HEADER_HEX}', {le_hex32_sql(_ref(n_points))})), "
                  f"coalesce({_ref(body)}, X''))")


def collect_points_sql(wkb_col: str) -> Column:
    """AGG-4: the points of a group, concatenated in WKB byte order.

    ``listagg`` skips NULLs and runs as partial + final aggregate.
    """
    return F.expr(f"listagg({_ref(wkb_col)}) WITHIN GROUP (ORDER BY {_ref(wkb_col)})")


# ---------------------------------------------------------------------------
# EXP-6: decode
# ---------------------------------------------------------------------------
def _hex_of(wkb: str) -> str:
    return f"hex({_ref(wkb)})"


def point_is_valid(wkb: str) -> Column:
    h = _hex_of(wkb)
    return F.expr(f"(length({_ref(wkb)}) = {POINT_BYTES} AND substring({h}, 1, 2) IN ('00', '01') "
                  f"AND {_u32_sql(h, 3)} = 1L)")


def _multipoint_count_sql(wkb: str) -> str:
    return _u32_sql(_hex_of(wkb), 11)


def with_point_xy(df: DataFrame, wkb: str, x_out: str = "lon", y_out: str = "lat") -> DataFrame:
    """Add the x and y of a WKB Point column (staged, see above): hex once,
    four 4-byte halves, byte order fixed by arithmetic, then the doubles."""
    p = f"__{x_out}_{y_out}_"
    s1 = df.selectExpr("*", f"hex({_ref(wkb)}) AS `{p}h`")
    halves = [(c, k, pos) for c, base in (("x", 11), ("y", 27)) for k, pos in (("a", base), ("b", base + 8))]
    s2 = s1.selectExpr("*", f"substring(`{p}h`, 1, 2) = '01' AS `{p}le`",
                       *[f"{_half_sql(f'`{p}h`', pos)} AS `{p}{c}{k}`" for c, k, pos in halves])
    parts = {c: _hi_lo_sql(f"`{p}le`", f"`{p}{c}a`", f"`{p}{c}b`") for c in "xy"}
    s3 = s2.selectExpr("*", *[f"{parts[c][i]} AS `{p}{c}{n}`" for c in "xy" for i, n in ((0, "hi"), (1, "lo"))])
    return s3.selectExpr(*[f"`{c}`" for c in df.columns if c not in (x_out, y_out)],
                         f"{_bits_to_double_sql(f'`{p}xhi`', f'`{p}xlo`')} AS `{x_out}`",
                         f"{_bits_to_double_sql(f'`{p}yhi`', f'`{p}ylo`')} AS `{y_out}`")


def multipoint_count(wkb: str) -> Column:
    return F.expr(_multipoint_count_sql(wkb))


def multipoint_is_valid(wkb: str) -> Column:
    """Head, length, and the head of every member: a Point in either byte
    order, each member in its own."""
    w, h = _ref(wkb), _hex_of(wkb)
    n = _multipoint_count_sql(wkb)
    member = f"hex(substr({w}, {MULTIPOINT_HEADER_BYTES + 1} + i * {POINT_BYTES}, {POINT_HEADER_BYTES}))"
    return F.expr(f"(CASE WHEN substring({h}, 1, 2) NOT IN ('00', '01') OR {_u32_sql(h, 3)} <> 4L "
                  f"OR length({w}) <> {MULTIPOINT_HEADER_BYTES} + {n} * {POINT_BYTES} THEN false WHEN {n} = 0L THEN true "
                  f"ELSE forall(sequence(0L, {n} - 1L), i -> {member} IN ({', '.join(repr(x) for x in POINT_HEADERS_HEX)})) END)")


def multipoint_points(wkb: str) -> Column:
    """Array of the member points' WKB (explode it for one row per point)."""
    w, n = _ref(wkb), _multipoint_count_sql(wkb)
    return F.expr(f"CASE WHEN {n} > 0 THEN transform(sequence(0L, {n} - 1L), "
                  f"i -> substr({w}, {MULTIPOINT_HEADER_BYTES + 1} + i * {POINT_BYTES}, {POINT_BYTES})) "
                  f"ELSE CAST(array() AS ARRAY<BINARY>) END")


# ---------------------------------------------------------------------------
# Typed geometry columns: the serving tables' geometry(Point|MultiPoint, SRID)
# ---------------------------------------------------------------------------
def typed_geometry(column: str, geometry_type: str, srid: int = SRID) -> Column:
    """The WKB column with its geometry type and SRID as field metadata
    (kept in the Parquet schema; WKB itself carries no SRID)."""
    return F.col(column).alias(column, metadata={"encoding": "WKB", "geometry_type": geometry_type,
                                                 "srid": srid})


def require_valid(df: DataFrame, column: str, geometry_type: str) -> DataFrame:
    """Abort on a non-NULL value that is not well-formed WKB of the given
    type (byte order flag, type code, length), as loading it into a typed
    geometry column would."""
    check = {"Point": point_is_valid, "MultiPoint": multipoint_is_valid}[geometry_type](column)
    ok = F.col(column).isNull() | check
    return df.withColumn(column, F.when(ok, F.col(column)).otherwise(
        F.raise_error(F.lit(f"{column}: not a valid WKB {geometry_type}"))))
