"""Calendar helpers (M1-M3): month lists, available months, densified series."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_YEAR = 2020


def validate_period(start_year: int, end_year: int | None = None, start_month: int | None = None,
                    end_month: int | None = None, *, as_of: _dt.date | None = None) -> tuple[str, str]:
    """M1 rules: year >= 2020, not in the future (relative to ``as_of``), start <= end.

    A missing start month means 1, a missing end month 12.  Returns the
    (first, last) months as 'YYYYMM'.
    """
    single_month = start_month is not None and end_year is None and end_month is None
    end_year = end_year if end_year is not None else start_year
    sm = start_month or 1
    em = start_month if single_month else (end_month or 12)
    for m in (sm, em):
        if not 1 <= m <= 12:
            raise ValueError(f"month out of range: {m}")
    if start_year < MIN_YEAR:
        raise ValueError(f"year {start_year} before {MIN_YEAR}")
    if as_of is not None and (end_year, em) > (as_of.year, as_of.month):
        raise ValueError("period ends in the future")
    first, last = f"{start_year:04d}{sm:02d}", f"{end_year:04d}{em:02d}"
    if first > last:
        raise ValueError("start after end")
    return first, last


def months_between_expr(first: Column, last: Column) -> Column:
    """Array of 'YYYYMM' strings from ``first`` to ``last`` inclusive (column expressions)."""
    d0 = F.to_date(F.concat(first, F.lit("01")), "yyyyMMdd")
    d1 = F.to_date(F.concat(last, F.lit("01")), "yyyyMMdd")
    return F.transform(F.sequence(d0, d1, F.expr("INTERVAL 1 MONTH")), lambda d: F.date_format(d, "yyyyMM"))


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """M1 from literals: one row per month (column ``competencia``)."""
    return spark.range(1).select(F.explode(months_between_expr(F.lit(first), F.lit(last))).alias("competencia"))


def calendar_of(df: DataFrame, month: str = "competencia") -> DataFrame:
    """M1 spanning the months present in ``df`` (min..max), one row per month."""
    return (df.agg(F.min(month).alias("_a"), F.max(month).alias("_b"))
            .select(F.explode(months_between_expr(F.col("_a"), F.col("_b"))).alias("competencia")))


def available_months(catalog: DataFrame, year: int | None = None, *, name: str = "file_name") -> DataFrame:
    """M2: distinct 6-digit months found in file/directory names, month 1-12, optional year prefix."""
    m = F.regexp_extract(F.col(name), r"(\d{6})", 1)
    out = catalog.select(m.alias("competencia")).where(F.col("competencia").rlike(r"^\d{6}$"))
    out = out.where(F.substring("competencia", 5, 2).cast("int").between(1, 12))
    if year is not None:
        out = out.where(F.col("competencia").startswith(str(year)))
    return out.distinct()


def densify(series: DataFrame, cal: DataFrame, *, month: str = "competencia", fill: dict | None = None) -> DataFrame:
    """M3: every calendar month present; missing months get the fill values (default 0)."""
    joined = cal.join(series, cal["competencia"] == series[month], "left")
    fill_cols = fill or {c: 0 for c in series.columns if c != month}
    return joined.select(cal["competencia"].alias(month),
                         *[F.coalesce(series[c], F.lit(v)).alias(c) for c, v in fill_cols.items()])
