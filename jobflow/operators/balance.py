"""Monthly balance (saldo) and running stock (estoque).

Plan shape of :func:`balance_series` on a movement fact table of any size:
scan (pruned to 4 columns) -> per-row expressions -> ONE hash aggregate by
month (partial aggregation map-side, so the shuffle carries at most
#months x #partitions rows) -> window over the one-row-per-month result.
The ordered window has no partition key on purpose: its input is the tiny
monthly series (hundreds of rows), never fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobflow.functions.codes import ADMISSION, SEPARATION, direction

# fixed values: opening stock of the anchor month, and the level the unit tests use
DEFAULT_ANCHOR = "202001"
DEFAULT_BASELINE = 39054507
TEST_BASELINE = 39567082



def classify_movement(df: DataFrame, *, code: str = "tipo_movimentacao", out: str = "direction") -> DataFrame:
    """Direction 'A' / 'D' by code list or upper-cased alias, else null."""
    return df.withColumn(out, direction(F.col(code)))


def signed_balance(tipo: Column, saldo: Column) -> Column:
    """B18 as an expression: exclusions are sign-inverted (1 -> -1, -1 -> 1, x -> -x)."""
    return F.when(tipo == "EXC", -saldo).otherwise(saldo)


def invert_exclusions(df: DataFrame, *, tipo: str = "tipo", saldo: str = "saldo_movimentacao") -> DataFrame:
    """Invert the balance sign of exclusion rows."""
    return df.withColumn(saldo, signed_balance(F.col(tipo), F.col(saldo)))


def tag_source(df: DataFrame, tipo: str, *, out: str = "tipo") -> DataFrame:
    """Literal source tag (MOV / EXC / FOR)."""
    return df.withColumn(out, F.lit(tipo))


def union_sources(mov: DataFrame | None, exc: DataFrame | None, fora: DataFrame | None, *,
                  saldo: str = "saldo_movimentacao") -> DataFrame:
    """H1: stack MOV + sign-inverted EXC + FOR by column name (narrow, no shuffle)."""
    parts = []
    if mov is not None:
        parts.append(tag_source(mov, "MOV"))
    if exc is not None:
        parts.append(tag_source(exc, "EXC").withColumn(saldo, -F.col(saldo)))
    if fora is not None:
        parts.append(tag_source(fora, "FOR"))
    if not parts:
        raise ValueError("union_sources needs at least one source")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def balance_long(df: DataFrame, *, month: str = "competencia_mov", code: str = "tipo_movimentacao",
                 tipo: str = "tipo", saldo: str = "saldo_movimentacao") -> DataFrame:
    """(competencia, direction) -> total_saldo, n_registros; unknown codes dropped."""
    d = direction(F.col(code))
    return (df.select(F.col(month).cast("string").alias("competencia"), d.alias("direction"),
                      signed_balance(F.col(tipo), F.col(saldo)).alias("s"))
            .where(F.col("direction").isNotNull())
            .groupBy("competencia", "direction")
            .agg(F.sum("s").cast("bigint").alias("total_saldo"), F.count(F.lit(1)).alias("n_registros")))


def month_of(month: str = "competencia_mov", *, tipo: str = "tipo", exclusion_month: str = "movement",
             declared: str = "competencia_dec") -> Column:
    """Month a row is counted in.  Exclusions use the movement month by default (as the code
    does); ``exclusion_month='declared'`` counts them in the month they were informed."""
    if exclusion_month == "movement":
        return F.col(month).cast("string")
    if exclusion_month == "declared":
        return F.when(F.col(tipo) == "EXC", F.col(declared)).otherwise(F.col(month)).cast("string")
    raise ValueError("exclusion_month must be 'movement' or 'declared'")


def balance_pivot(df: DataFrame, *, month: str = "competencia_mov", code: str = "tipo_movimentacao",
                  tipo: str = "tipo", saldo: str = "saldo_movimentacao", by=(),
                  exclusion_month: str = "movement", declared: str = "competencia_dec") -> DataFrame:
    """Direction pivoted to columns with explicit values; a missing direction gives 0.

    With the pivot values known (A, D) the pivot is written as two conditional
    sums in ONE aggregate: one shuffle of partial sums, where ``groupBy.pivot``
    would plan a second aggregate and exchange.
    """
    d = direction(F.col(code))
    s = signed_balance(F.col(tipo), F.col(saldo))
    by = list(by)
    m = month_of(month, tipo=tipo, exclusion_month=exclusion_month, declared=declared)
    return (df.select(m.alias("competencia"), *by, d.alias("direction"), s.alias("s"))
            .where(F.col("direction").isNotNull())
            .groupBy("competencia", *by)
            .agg(F.coalesce(F.sum(F.when(F.col("direction") == ADMISSION, F.col("s"))), F.lit(0)).cast("bigint")
                 .alias("admissoes"),
                 F.coalesce(F.sum(F.when(F.col("direction") == SEPARATION, F.col("s"))), F.lit(0)).cast("bigint")
                 .alias("desligamentos")))


def monthly_balance(df: DataFrame, **cols) -> DataFrame:
    """Separations as absolute value, saldo_mensal = admissoes - |desligamentos|."""
    p = balance_pivot(df, **cols)
    by = list(cols.get("by", ()))
    return p.select("competencia", *by, "admissoes", F.abs("desligamentos").alias("desligamentos"),
                    (F.col("admissoes") - F.abs("desligamentos")).alias("saldo_mensal"))


def running_stock(bal: DataFrame, *, anchor: str = DEFAULT_ANCHOR, baseline: int = DEFAULT_BASELINE,
                  mode: str = "anchor", by: list[str] | tuple = (), month: str = "competencia",
                  saldo: str = "saldo_mensal", out: str = "estoque") -> DataFrame:
    """cumulative stock anchored at ``anchor``.

    mode='anchor' (F1): the baseline is added to the anchor month only; if it is
    absent, no baseline is added.  mode='first_on_or_after' (F2): the baseline
    goes to the first month >= anchor; a series entirely before it gets none.
    ``by`` (F3) runs one independent series per segment.
    """
    by = list(by)
    order = Window.partitionBy(*by).orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    if mode == "anchor":
        target = F.lit(anchor)
    elif mode == "first_on_or_after":
        target = F.min(F.when(F.col(month) >= anchor, F.col(month))).over(
            Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    add = F.when(F.col(month) == target, F.lit(baseline)).otherwise(F.lit(0))
    return bal.withColumn(out, F.sum(F.col(saldo) + add).over(order).cast("bigint"))


def balance_series(mov: DataFrame, *, anchor: str = DEFAULT_ANCHOR, baseline: int = DEFAULT_BASELINE,
                   mode: str = "anchor", **cols) -> DataFrame:
    """Movements -> (competencia, admissoes, desligamentos, saldo_mensal, estoque)."""
    return running_stock(monthly_balance(mov, **cols), anchor=anchor, baseline=baseline, mode=mode)


def append_recalc(old: DataFrame, new: DataFrame, **stock_kw) -> DataFrame:
    """H2: existing series + newly computed months, stock recomputed over the union."""
    cols = ["competencia", "admissoes", "desligamentos", "saldo_mensal"]
    return running_stock(old.select(*cols).unionByName(new.select(*cols)), **stock_kw)


def series_summary(bal: DataFrame) -> DataFrame:
    """first/last month, months, totals, final stock (stock of the last month)."""
    return bal.agg(
        F.min("competencia").alias("primeira"),
        F.max("competencia").alias("ultima"),
        F.count(F.lit(1)).alias("n_competencias"),
        F.sum("admissoes").cast("bigint").alias("total_admissoes"),
        F.sum("desligamentos").cast("bigint").alias("total_desligamentos"),
        F.sum("saldo_mensal").cast("bigint").alias("saldo_total"),
        F.max_by("estoque", "competencia").cast("bigint").alias("estoque_final"),
    )


def source_breakdown(df: DataFrame, *, month: str = "competencia_mov", code: str = "tipo_movimentacao",
                     tipo: str = "tipo", saldo: str = "saldo_movimentacao") -> DataFrame:
    """Per month: rows by source, late share, exclusions by direction (fills exc_*)."""
    d = direction(F.col(code))
    t = F.col(tipo)
    return (df.select(F.col(month).cast("string").alias("competencia"), t.alias("t"), d.alias("d"))
            .groupBy("competencia")
            .agg(F.count_if(F.col("t") == "MOV").alias("n_mov"),
                 F.count_if(F.col("t") == "FOR").alias("n_for"),
                 F.count_if(F.col("t") == "EXC").alias("n_exc"),
                 F.count_if((F.col("t") == "EXC") & (F.col("d") == ADMISSION)).alias("exc_admissoes"),
                 F.count_if((F.col("t") == "EXC") & (F.col("d") == SEPARATION)).alias("exc_desligamentos"),
                 F.round(F.count_if(F.col("t") == "FOR") / F.count(F.lit(1)) * 100.0, 6).alias("pct_fora_prazo")))


def balance_by_formula(df: DataFrame, *, month: str = "competencia_mov", code: str = "tipo_movimentacao",
                       tipo: str = "tipo", saldo: str = "saldo_movimentacao") -> DataFrame:
    """saldo = (A - D) over MOV+FOR  +  (excluded D - excluded A) over EXC.

    A and D are absolute sums of the balance column per direction, so with
    consistent signs this equals :func:`monthly_balance`'s ``saldo_mensal``.
    """
    d = direction(F.col(code))
    s = F.abs(F.col(saldo))
    t = F.col(tipo)
    regular = t != "EXC"
    return (df.where(d.isNotNull())
            .groupBy(F.col(month).cast("string").alias("competencia"))
            .agg(F.sum(F.when(regular & (d == ADMISSION), s).otherwise(0)).cast("bigint").alias("adm"),
                 F.sum(F.when(regular & (d == SEPARATION), s).otherwise(0)).cast("bigint").alias("desl"),
                 F.sum(F.when(~regular & (d == ADMISSION), s).otherwise(0)).cast("bigint").alias("exc_adm"),
                 F.sum(F.when(~regular & (d == SEPARATION), s).otherwise(0)).cast("bigint").alias("exc_desl"))
            .withColumn("saldo_formula", F.col("adm") - F.col("desl") + F.col("exc_desl") - F.col("exc_adm")))


def unrecognized(df: DataFrame, *, code: str = "tipo_movimentacao") -> DataFrame:
    """Unrecognised movement codes with their row counts."""
    return (df.where(direction(F.col(code)).isNull())
            .groupBy(F.col(code).cast("string").alias("codigo"))
            .agg(F.count(F.lit(1)).alias("n_registros")))
