"""Scalar cleaning expressions (all JVM-side, inside whole-stage codegen).

Every function takes and returns ``Column`` so it composes into ``select``.
Source data is dirty: nothing here raises under ANSI mode; failures give NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: ColumnOrName, to: str) -> Column:
    """SAFE_CAST: a failed cast gives NULL instead of an error."""
    return _c(c).try_cast(to)


def rounded(c: ColumnOrName, digits: int) -> Column:
    """``round(c, digits)`` of a double, through whole numbers unless it is near a tie or large: without a decimal for each row.

    A whole number over a power of ten is the double nearest to that decimal, which is what ``round`` gives.
    """
    x, ten = _c(c).cast("double"), F.lit(10.0 ** digits)
    y = x * ten
    whole = F.rint(y)
    return F.when((F.abs(y) < 1e12) & (F.abs(y - whole) < 0.499), (whole + 0.0) / ten).otherwise(F.round(x, digits))


def null_safe_sum(*cols: ColumnOrName) -> Column:
    """COALESCE(a,0) + COALESCE(b,0) + ... (deaths, injuries, damage totals)."""
    out = None
    for c in cols:
        term = F.coalesce(_c(c), F.lit(0))
        out = term if out is None else out + term
    return out


def coerce_int(c: ColumnOrName) -> Column:
    """First ``-?\\d+`` in the trimmed text as bigint; blank or none -> NULL.

    ``'1900?'`` -> 1900, ``' 1975 '`` -> 1975, ``'3.7'`` -> 3.
    """
    txt = F.trim(_c(c).cast("string"))
    hit = F.regexp_extract(txt, r"(-?\d+)", 1)
    return F.nullif(hit, F.lit("")).try_cast("bigint")


def coerce_float(c: ColumnOrName) -> Column:
    """Commas dropped, then the first ``-?\\d+(\\.\\d+)?`` as double.

    ``'12,345.6'`` -> 12345.6, ``'.5'`` -> 5.0, ``'1e5'`` -> 1.0, ``'n/a'`` -> NULL.
    """
    txt = F.regexp_replace(F.trim(_c(c).cast("string")), ",", "")
    hit = F.regexp_extract(txt, r"(-?\d+(\.\d+)?)", 1)
    return F.nullif(hit, F.lit("")).try_cast("double")


def pick_label(c: ColumnOrName, keys: Sequence[str]) -> Column:
    """A string from a scalar-or-object field stored as text.

    JSON object -> the first of ``keys`` that is present and not null;
    JSON array -> NULL; any other text -> itself.
    """
    col = _c(c).cast("string")
    head = F.ltrim(col)
    from_obj = F.coalesce(*[F.get_json_object(col, f"$.{k}") for k in keys])
    return (F.when(col.isNull(), F.lit(None).cast("string"))
            .when(head.startswith("{"), from_obj)
            .when(head.startswith("["), F.lit(None).cast("string"))
            .otherwise(col))


def datetime_from_parts(y: ColumnOrName, m: ColumnOrName, d: ColumnOrName,
                        hh: ColumnOrName, mm: ColumnOrName,
                        ss: ColumnOrName | None = None) -> Column:
    """DATETIME(y,m,d,hh,mm,floor(ss)) under range guards, else NULL.

    Seconds default to 0 and are floored; an impossible date (30 Feb) is NULL.
    """
    sec = F.coalesce(_c(ss).cast("double"), F.lit(0.0)) if ss is not None else F.lit(0.0)
    y, m, d, hh, mm = (_c(x) for x in (y, m, d, hh, mm))
    ok = ((y >= 1) & m.between(1, 12) & d.between(1, 31) & hh.between(0, 23)
          & mm.between(0, 59) & sec.between(0, 59.9999))
    ts = F.try_make_timestamp_ntz(y.cast("int"), m.cast("int"), d.cast("int"),
                                  hh.cast("int"), mm.cast("int"),
                                  F.floor(sec).cast("decimal(16,6)"))
    return F.when(ok, ts)


def parse_yyyymmdd(c: ColumnOrName) -> Column:
    """Integer day ``YYYYMMDD`` -> midnight timestamp_ntz; failure -> NULL."""
    return F.try_to_date(_c(c).cast("string"), "yyyyMMdd").cast("timestamp_ntz")


def yyyymmdd(c: ColumnOrName) -> Column:
    """Date -> ``YYYYMMDD`` integer (range bounds on integer-day columns)."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def grid_bin(c: ColumnOrName, size: float = 0.5) -> Column:
    """Grid bin ``floor(x / size)`` as bigint (0.5 deg bins -> floor(x*2))."""
    return F.floor(_c(c) / F.lit(float(size))).cast("bigint")


def format_iso_minute(c: ColumnOrName) -> Column:
    """``%Y-%m-%dT%H:%MZ``."""
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm'Z'")


def format_datetime(c: ColumnOrName) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` text, the same on every engine."""
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss")


def fmt_num(c: ColumnOrName, k: int) -> Column:
    """Number -> text with exactly ``k`` decimals (decimal cast, half away from zero).

    Used in place of a float-to-string cast, whose output differs between engines.
    """
    return _c(c).cast(f"decimal(38,{k})").cast("string") if k > 0 else \
        F.round(_c(c), 0).cast("decimal(38,0)").cast("string")


def fmt_whole(c: ColumnOrName) -> Column:
    """Number -> text with all its digits up to the ninth decimal, without trailing zeros.

    Nine decimals hold every measured value whole and cut only the rounding noise of computed
    ones, which differs between engines.
    """
    return F.regexp_replace(fmt_num(c, 9), r"\.?0+$", "")


def fmt_int(c: ColumnOrName) -> Column:
    """CAST(CAST(x AS INT64) AS STRING) with explicit rounding (never truncation)."""
    return F.round(_c(c), 0).cast("bigint").cast("string")


def log_population(c: ColumnOrName) -> Column:
    """SAFE.LOG10(1 + COALESCE(pop, 0)); non-positive argument -> NULL."""
    arg = F.lit(1.0) + F.coalesce(_c(c).cast("double"), F.lit(0.0))
    return F.when(arg > 0, F.log10(arg))


def valid_coords(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    """Latitude in [-90, 90] and longitude in [-180, 180], both inclusive."""
    return _c(lat).between(-90.0, 90.0) & _c(lon).between(-180.0, 180.0)


def year_between(c: ColumnOrName, lo: int = 1901, hi: int = 2025) -> Column:
    return F.year(_c(c)).between(lo, hi)
