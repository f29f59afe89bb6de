"""Column expressions shared by every layer.

All helpers return ``pyspark.sql.Column`` built from JVM-side functions, so
they stay inside whole-stage codegen. Semantics follow the warehouse the trip
models were written for (see the README, "Semantics"):

* ``minutes_between(mode="boundary")`` counts minute boundaries crossed
  (10:00:45 -> 10:01:15 is 1); ``mode="fractional"`` is whole seconds / 60.
* ``round_half_away`` rounds half away from zero on the double value.
* ``surrogate_key`` hashes a canonical text of each part, NULL -> ''.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- durations

def minutes_between(start: ColumnOrName, end: ColumnOrName,
                    mode: str = "boundary") -> Column:
    """Minutes from ``start`` to ``end``.

    boundary:   number of minute boundaries crossed (integer, bigint).
    fractional: whole seconds between second-truncated times, / 60 (double).
    NULL in either input gives NULL.
    """
    s, e = _c(start), _c(end)
    if mode == "boundary":
        return F.timestamp_diff("MINUTE", F.date_trunc("minute", s),
                                F.date_trunc("minute", e))
    if mode == "fractional":
        secs = F.timestamp_diff("SECOND", F.date_trunc("second", s),
                                F.date_trunc("second", e))
        return secs.cast("double") / F.lit(60.0)
    raise ValueError(f"unknown duration mode {mode!r}")


# ---------------------------------------------------------------- rounding

# ``floor`` of a double gives a long: from here on it would give the largest one.
LONG_LIMIT = 2.0 ** 63


def round_half_away(x: ColumnOrName, digits: int = 2) -> Column:
    """Round a double half away from zero: sign * floor(|x| * 10^d + 0.5) / 10^d.

    Written as plain double arithmetic so any SQL engine computing the same
    formula on the same double gets the same bits. A double whose scaled value
    is beyond a long has no digits left to round (nor have NaN and infinities):
    it is returned as it is.
    """
    v = _c(x).cast("double")
    f = float(10 ** digits)
    small = F.abs(v * F.lit(f)) < F.lit(LONG_LIMIT)
    pos = F.floor(v * F.lit(f) + F.lit(0.5)).cast("double") / F.lit(f)
    neg = -(F.floor(-v * F.lit(f) + F.lit(0.5)).cast("double") / F.lit(f))
    return F.when(small, F.when(v >= 0, pos).otherwise(neg)).otherwise(v)


# Beyond this a double's sum is left to double arithmetic (decimal(38,10)
# holds 28 digits before the point).
EXACT_LIMIT = 1e27


def exact_sum(x: ColumnOrName) -> Column:
    """Order-independent sum of a double column (decimal accumulation).

    Double addition is not associative, so a plain ``sum`` depends on the
    partitioning. Summing in decimal(38,10) is exact and gives the same value
    however the rows are split across tasks; the result is returned as double.
    NaN, infinities and values beyond ``EXACT_LIMIT`` are summed apart as doubles
    and added, so NaN and infinity carry through as in ``sum``; a group without
    any has nothing to add.
    """
    return _joined(*exact_sum_parts(x))


def exact_sum_parts(x: ColumnOrName) -> tuple[Column, Column]:
    """The two aggregates of ``exact_sum``, to be kept and merged (``merged_sum``):
    the decimal sum, and the double sum of the values that do not fit it."""
    v = _c(x).cast("double")
    fits = F.coalesce(F.abs(v) < F.lit(EXACT_LIMIT), F.lit(True)) & ~F.coalesce(F.isnan(v), F.lit(False))
    return F.sum(F.when(fits, v).cast(T.DecimalType(38, 10))), F.sum(F.when(~fits, v))


def merged_sum(total: ColumnOrName, rest: ColumnOrName) -> Column:
    """``exact_sum`` of all rows from kept ``exact_sum_parts``."""
    return _joined(F.sum(_c(total)), F.sum(_c(rest)))


def _joined(total: Column, rest: Column) -> Column:
    exact = total.cast("double")
    return F.when(rest.isNull(), exact).otherwise(rest + F.coalesce(exact, F.lit(0.0)))


def exact_avg(x: ColumnOrName) -> Column:
    """Mean of the non-NULL values computed from ``exact_sum`` (double); NaN and
    infinities carry through, as in ``avg``."""
    return F.try_divide(exact_sum(x), F.count(_c(x)).cast("double"))


def pct(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """100 * part / whole as double; NULL when whole is 0 or NULL."""
    return F.try_divide(F.lit(100.0) * _c(part).cast("double"),
                        F.nullif(_c(whole).cast("double"), F.lit(0.0)))


# ---------------------------------------------------------------- text keys

def canonical_text(c: ColumnOrName, dtype: T.DataType) -> Column:
    """Engine-independent text for a value, used inside hash keys.

    integers -> decimal digits; floats -> micro-units as an integer,
    ``floor(x * 1e6 + 0.5)`` (plain IEEE arithmetic, so every engine produces
    the same digits, unlike double -> text or double -> decimal casts), or the
    double's shortest text where that is beyond a long, NaN or an infinity;
    timestamps -> 'yyyy-MM-dd HH:mm:ss.SSSSSS'; dates -> 'yyyy-MM-dd'.
    """
    col = _c(c)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return col.cast("string")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        micros = col.cast("double") * F.lit(1e6) + F.lit(0.5)
        return (F.when(F.abs(micros) < F.lit(LONG_LIMIT), F.floor(micros).cast("string"))
                 .otherwise(col.cast("double").cast("string")))
    if isinstance(dtype, T.DecimalType):
        return col.cast("string")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(dtype, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    if isinstance(dtype, T.BooleanType):
        return F.when(col, F.lit("true")).when(~col, F.lit("false"))
    return col.cast("string")


def surrogate_key(df_schema: T.StructType, cols: Iterable[str]) -> Column:
    """Null-safe md5 over the canonical text of ``cols`` joined by '|'.

    A NULL part contributes '' so the key itself is never NULL.
    """
    types = {f.name: f.dataType for f in df_schema.fields}
    parts: list[Column] = []
    for i, name in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(F.coalesce(canonical_text(name, types[name]), F.lit("")))
    return F.md5(F.concat(*parts))


def grain_key(df_schema: T.StructType, cols: Iterable[str]) -> Column:
    """md5 of the parts joined by '|' where any NULL part makes the key NULL."""
    types = {f.name: f.dataType for f in df_schema.fields}
    parts: list[Column] = []
    for i, name in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(canonical_text(name, types[name]))
    return F.md5(F.concat(*parts))


# ---------------------------------------------------------------- labels

def label(c: ColumnOrName, mapping: Mapping, default: str | None = None) -> Column:
    """Code -> label as a CASE expression (for small, fixed mappings).

    A NULL code falls to ``default`` like the SQL ``else`` branch.
    """
    col = _c(c)
    expr = None
    for code, text in mapping.items():
        expr = (F.when(col == F.lit(code), F.lit(text)) if expr is None
                else expr.when(col == F.lit(code), F.lit(text)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def share_flag(cond: Column) -> Column:
    """0/1 integer of a condition, for averages of a condition (NULL -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


# ---------------------------------------------------------------- dates

def month_from_name(name: ColumnOrName) -> Column:
    """First day of the YYYY-MM month embedded in a file name, else NULL.

    One expression without branches, for it runs on every landed row: a name
    without a month leaves '-01', which is no date.
    """
    ym = F.regexp_extract(_c(name), r"([0-9]{4}-[0-9]{2})", 1)
    return F.concat(ym, F.lit("-01")).try_cast("date")


def year_range(ts: ColumnOrName, year: int) -> Column:
    """``year(ts) = year`` written as a half-open range so it reaches the scan."""
    return ((_c(ts) >= F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz"))
            & (_c(ts) < F.lit(f"{year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")))


def day_name(ts: ColumnOrName) -> Column:
    """Full English day name, e.g. 'Sunday'."""
    return F.date_format(_c(ts), "EEEE")


# ---------------------------------------------------------------- semi-structured

def json_extract(c: ColumnOrName, path: str, dtype: str) -> Column:
    """Typed field from a JSON string column: ``$.a.b`` path, cast to ``dtype``.

    Malformed JSON or a value that does not cast gives NULL.
    """
    return F.get_json_object(_c(c), path).try_cast(dtype)


def json_fields(df: DataFrame, col: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``df`` with one typed column per entry of ``fields`` (name -> (path, type))
    from a JSON string column, whose text is parsed once per row into a VARIANT
    however many fields are read. Paths may lead through objects (``$.a.b``) and
    arrays (``$.a[0]``). Malformed JSON, a missing path or a value that does not
    cast gives NULL.
    """
    parsed = df.select("*", F.try_parse_json(F.col(col)).alias("__variant"))
    return parsed.select(*[parsed[c] for c in df.columns],
                         *[F.try_variant_get(parsed["__variant"], path, dtype).alias(name)
                           for name, (path, dtype) in fields.items()])
