"""Time-series window operators over monthly series.

Inputs here are series (one row per month, or per segment and month), so
windows either partition by the segment or run on a few hundred rows.
``month_gaps`` partitions by the entity key, so it parallelises over
companies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_date(c: Column) -> Column:
    """'YYYYMM' text -> first day of the month as a date; null if it is no month."""
    return F.try_to_date(F.concat(c, F.lit("01")), "yyyyMMdd")


def month_text(d: Column) -> Column:
    return F.date_format(d, "yyyyMM")


def ytd(bal: DataFrame, *, month: str = "competencia", value: str = "saldo_mensal", out: str = "saldo_ano",
        by=()) -> DataFrame:
    """year-to-date cumulative sum."""
    w = (Window.partitionBy(*by, F.substring(F.col(month), 1, 4)).orderBy(month)
         .rowsBetween(Window.unboundedPreceding, 0))
    return bal.withColumn(out, F.sum(value).over(w).cast("bigint"))


def pct_change(bal: DataFrame, *, month: str = "competencia", value: str = "estoque", out: str | None = None,
               by=()) -> DataFrame:
    """month-on-month % change; null for the first month or a zero previous value."""
    out = out or f"var_pct_{value}"
    prev = F.lag(value).over(Window.partitionBy(*by).orderBy(month))
    return bal.withColumn(out, F.round(F.when(prev != 0, (F.col(value) - prev) / F.abs(prev) * 100.0), 6))


def moving_avg(bal: DataFrame, k: int = 3, *, month: str = "competencia", value: str = "saldo_mensal",
               out: str | None = None, by=()) -> DataFrame:
    """trailing k-row moving average (fewer rows at the start of the series)."""
    out = out or f"media_movel_{k}"
    w = Window.partitionBy(*by).orderBy(month).rowsBetween(-(k - 1), 0)
    return bal.withColumn(out, F.round(F.avg(value).over(w), 6))


def seasonality(bal: DataFrame, *, month: str = "competencia", value: str = "admissoes") -> DataFrame:
    """per calendar month, mean value / overall mean (one row per month of year).

    Computed as a grouped aggregate over the series then a window over the 12
    result rows, instead of an unpartitioned window over the series.
    """
    per = (bal.groupBy(F.substring(F.col(month), 5, 2).cast("int").alias("mes"))
           .agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n")))
    allw = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    overall = F.sum("_s").over(allw) / F.sum("_n").over(allw)
    return per.select("mes", F.round(F.col("_s") / F.col("_n"), 6).alias("media_mes"),
                      F.round(overall, 6).alias("media_geral"),
                      F.round((F.col("_s") / F.col("_n")) / overall, 6).alias("indice_sazonal"))


def month_gaps(df: DataFrame, *, month: str = "competencia_mov", by=()) -> DataFrame:
    """Missing month ranges between consecutive present months (per ``by`` key).

    Returns (by..., inicio_lacuna, fim_lacuna, meses_faltantes); a dense series gives no rows.
    Values that are no month are left out.
    """
    months = df.select(*by, month_date(F.col(month).cast("string")).alias("_d")).where("_d IS NOT NULL").distinct()
    w = Window.partitionBy(*by).orderBy("_d")
    g = months.select(*by, "_d", F.lead("_d").over(w).alias("_next"))
    gap = F.months_between(F.col("_next"), F.col("_d")).cast("int")
    return (g.where(gap > 1)
            .select(*by, month_text(F.add_months("_d", 1)).alias("inicio_lacuna"),
                    month_text(F.add_months("_next", -1)).alias("fim_lacuna"),
                    (gap - 1).alias("meses_faltantes")))
