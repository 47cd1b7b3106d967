"""Documented analytics over movements.

Grouped aggregates run with partial aggregation.  The person-level sequence
operators (E28 transitions, E29 tenure) need each person's rows in time
order; they first collapse rows to one per (person, month, value) with a
map-side-combined aggregate, so a person with very many raw rows shrinks to
at most one row per month before the ordered window runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobflow.functions.codes import ADMISSION, SEPARATION, direction
from jobflow.operators.balance import signed_balance


def month_index(c: Column) -> Column:
    """'YYYYMM' -> months since year 0 (integer, for month arithmetic); null if it holds no numbers."""
    return F.substring(c, 1, 4).try_cast("int") * 12 + F.substring(c, 5, 2).try_cast("int") - 1


def entity_indicators(df: DataFrame, *, tipo="tipo", code="tipo_movimentacao", uf="uf") -> DataFrame:
    """Long (indicador, valor) totals: entities, movements, exclusions, late, admissions,
    separations, net, UFs - one aggregate, then stacked."""
    d = direction(F.col(code))
    one = df.agg(
        F.count(F.lit(1)).alias("total_entidades"),
        F.count_if(F.col(tipo) == "MOV").alias("total_movimentacoes"),
        F.count_if(F.col(tipo) == "EXC").alias("total_exclusoes"),
        F.count_if(F.col(tipo) == "FOR").alias("total_fora_prazo"),
        F.count_if(d == ADMISSION).alias("total_admissoes"),
        F.count_if(d == SEPARATION).alias("total_desligamentos"),
        F.count_distinct(F.col(uf)).alias("total_ufs"))
    one = one.withColumn("saldo_liquido", F.col("total_admissoes") - F.col("total_desligamentos"))
    names = ["total_entidades", "total_movimentacoes", "total_exclusoes", "total_fora_prazo", "total_admissoes",
             "total_desligamentos", "saldo_liquido", "total_ufs"]
    return one.select(*[F.col(n).cast("double").alias(n) for n in names]).unpivot([], names, "indicador", "valor")


def age_band(c: Column) -> Column:
    # fixed values: age bands of the published tables
    return (F.when(c < 18, "ate_17").when(c < 25, "18_24").when(c < 30, "25_29").when(c < 40, "30_39")
            .when(c < 50, "40_49").when(c < 65, "50_64").otherwise("65_mais"))


def contract_type(intermittent: Column, hours: Column, part_time_below: float = 25.0) -> Column:
    """Contract segment: intermittent flag first, then weekly hours below the part-time limit, else full time."""
    return F.when(intermittent, "intermitente").when(hours < part_time_below, "parcial").otherwise("integral")


def _balance_aggs(code: str, tipo: str, saldo: str):
    d = direction(F.col(code))
    s = signed_balance(F.col(tipo), F.col(saldo))
    adm = F.coalesce(F.sum(F.when(d == ADMISSION, s)), F.lit(0)).cast("bigint")
    des = F.abs(F.coalesce(F.sum(F.when(d == SEPARATION, s)), F.lit(0))).cast("bigint")
    return adm, des


def segments(df: DataFrame, dims: dict[str, Column], *, code="tipo_movimentacao", tipo="tipo",
             saldo="saldo_movimentacao") -> DataFrame:
    """Balance by each segment dimension, stacked as (dimensao, valor, admissoes, desligamentos, saldo).

    One ``groupingSets`` aggregate covers all dimensions in a single shuffle.
    """
    names = list(dims)
    base = df.select(*[e.cast("string").alias(n) for n, e in dims.items()], code, tipo, saldo)
    base = base.where(direction(F.col(code)).isNotNull())
    adm, des = _balance_aggs(code, tipo, saldo)
    g = base.groupingSets([[n] for n in names], *names).agg(adm.alias("admissoes"), des.alias("desligamentos"),
                                                             F.grouping_id().alias("_gid"))
    full = (1 << len(names)) - 1
    dim = None
    val = None
    for i, n in enumerate(names):
        gid = full ^ (1 << (len(names) - 1 - i))
        dim = F.when(F.col("_gid") == gid, F.lit(n)) if dim is None else dim.when(F.col("_gid") == gid, F.lit(n))
        val = F.when(F.col("_gid") == gid, F.col(n)) if val is None else val.when(F.col("_gid") == gid, F.col(n))
    return g.select(dim.alias("dimensao"), val.alias("valor"), "admissoes", "desligamentos",
                    (F.col("admissoes") - F.col("desligamentos")).alias("saldo"))


def segment_cube(df: DataFrame, a: str, b: str, *, code="tipo_movimentacao", tipo="tipo",
                 saldo="saldo_movimentacao") -> DataFrame:
    """E24 cross: CUBE(a, b) balance with 'TOTAL' labels for rolled-up levels."""
    base = df.where(direction(F.col(code)).isNotNull())
    adm, des = _balance_aggs(code, tipo, saldo)
    g = base.cube(a, b).agg(adm.alias("admissoes"), des.alias("desligamentos"),
                            F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"))
    return g.select(F.when(F.col("_ga") == 1, F.lit("TOTAL")).otherwise(F.col(a).cast("string")).alias(a),
                    F.when(F.col("_gb") == 1, F.lit("TOTAL")).otherwise(F.col(b).cast("string")).alias(b),
                    "admissoes", "desligamentos", (F.col("admissoes") - F.col("desligamentos")).alias("saldo"))


def fixed_point(c: Column, scale: int = 2) -> Column:
    """Money / durations with ``scale`` decimals as exact integers (cents)."""
    return F.round(c * (10 ** scale)).cast("bigint")


def exact_mean(total: Column, n: Column, scale: int = 2) -> Column:
    """Mean from an exact integer sum: one division, so the result does not depend on the
    order in which partial sums were combined (plain ``avg`` over doubles does)."""
    return F.when(n > 0, total.cast("double") / n / float(10 ** scale))


def mean_salary(df: DataFrame, *, by=("competencia_mov",), code="tipo_movimentacao", salary="salario",
                scale: int = 2) -> DataFrame:
    """Mean salary of admitted and of separated workers per group (exact fixed-point sums)."""
    d = direction(F.col(code))
    cents = fixed_point(F.col(salary), scale)
    a, s = F.when(d == ADMISSION, cents), F.when(d == SEPARATION, cents)
    return df.groupBy(*by).agg(
        exact_mean(F.sum(a), F.count(a), scale).alias("salario_medio_admitidos"),
        exact_mean(F.sum(s), F.count(s), scale).alias("salario_medio_desligados"))


def turnover(series: DataFrame) -> DataFrame:
    """(A + D) / mean(opening, closing stock) per month (opening = closing - balance)."""
    opening = F.col("estoque") - F.col("saldo_mensal")
    mean_stock = (opening + F.col("estoque")) / 2.0
    return series.select("competencia", "admissoes", "desligamentos", "estoque",
                         F.round(F.when(mean_stock != 0, (F.col("admissoes") + F.col("desligamentos")) / mean_stock), 9)
                         .alias("rotatividade"))


def disparity(df: DataFrame, group: str, *, code="tipo_movimentacao", tipo="tipo", saldo="saldo_movimentacao",
              salary="salario") -> DataFrame:
    """Per group: admitted mean salary gap vs overall (%), share of the total balance (%).

    The overall mean and total come from one more aggregate over the per-group
    rows, fetched as two numbers, so any number of groups stays distributed
    (no single-partition window over the groups).
    """
    d = direction(F.col(code))
    s = signed_balance(F.col(tipo), F.col(saldo))
    g = df.where(d.isNotNull()).groupBy(group).agg(
        F.sum(F.when(d == ADMISSION, fixed_point(F.col(salary)))).alias("_sal"), F.count_if(d == ADMISSION).alias("_na"),
        F.sum(s).alias("saldo"))
    tot = g.agg(exact_mean(F.sum("_sal"), F.sum("_na")).alias("media"), F.sum("saldo").alias("saldo")).first()
    overall, total = F.lit(tot["media"]).cast("double"), F.lit(tot["saldo"]).cast("double")
    mean = exact_mean(F.col("_sal"), F.col("_na"))
    return g.select(group, F.round(mean, 6).alias("salario_medio_admitidos"),
                    F.round((mean / overall - 1) * 100.0, 6).alias("diferenca_salarial_pct"),
                    F.col("saldo").cast("bigint").alias("saldo"),
                    F.round(F.col("saldo") / total * 100.0, 6).alias("participacao_saldo_pct"))


def transitions(df: DataFrame, *, person="cpf", seg="secao", month="competencia_mov") -> DataFrame:
    """Flow matrix between consecutive segments of the same person.

    Rows collapse to distinct (person, month, segment) first (map-side
    combine), then ``lag`` over each person's months gives the previous
    segment; within a month, segments are ordered by name.
    """
    states = df.select(person, month, seg).distinct()
    w = Window.partitionBy(person).orderBy(month, seg)
    prev = states.withColumn("origem", F.lag(seg).over(w))
    return (prev.where(F.col("origem").isNotNull())
            .groupBy("origem", F.col(seg).alias("destino")).agg(F.count(F.lit(1)).alias("transicoes")))


def tenure(df: DataFrame, *, key=("cnpj", "cpf"), month="competencia_mov", code="tipo_movimentacao") -> DataFrame:
    """Spells: each admission month paired with the next separation month of the same
    (company, person); duration in months.  Without a later separation the spell is
    censored at the last month that (company, person) is observed.

    Rows first collapse to (key, month, has_admission, has_separation), at most
    one per month, then ordered windows over each key find the next separation.
    """
    d = direction(F.col(code))
    per_month = df.groupBy(*key, month).agg(F.max(d == ADMISSION).alias("adm"), F.max(d == SEPARATION).alias("sep"))
    m = month_index(F.col(month))
    after = Window.partitionBy(*key).orderBy(month).rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy(*key)
    nxt = F.coalesce(F.when(F.col("sep"), m), F.min(F.when(F.col("sep"), m)).over(after))
    spells = per_month.select(*key, month, "adm", m.alias("_m"), nxt.alias("_s"), F.max(m).over(whole).alias("_last"))
    return spells.where(F.col("adm")).select(
        *key, F.col(month).alias("coorte"), F.col("_s").isNotNull().alias("evento"),
        F.coalesce(F.col("_s") - F.col("_m"), F.col("_last") - F.col("_m")).alias("duracao"))


def kaplan_meier(spells: DataFrame) -> DataFrame:
    """Survival S(t) = prod_{u<=t} (1 - d_u / n_u) over spell durations.

    Aggregated to one row per duration first (tiny), then computed with
    windows as exp(sum(log(1 - d/n))); a step with d = n sets S to 0 from then on.
    """
    per = spells.groupBy("duracao").agg(F.count_if("evento").alias("eventos"),
                                        F.count_if(~F.col("evento")).alias("censurados"))
    rev = Window.orderBy(F.col("duracao").desc()).rowsBetween(Window.unboundedPreceding, 0)
    fwd = Window.orderBy("duracao").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("em_risco", F.sum(F.col("eventos") + F.col("censurados")).over(rev))
    q = 1 - F.col("eventos") / F.col("em_risco")
    logs = F.sum(F.when(q > 0, F.log(q)).otherwise(0.0)).over(fwd)
    dead = F.max(F.when(q <= 0, 1).otherwise(0)).over(fwd)
    return per.select("duracao", "em_risco", "eventos", "censurados",
                      F.round(F.when(dead == 1, 0.0).otherwise(F.exp(logs)), 6).alias("sobrevivencia"))


def cohort_retention(spells: DataFrame, horizons=(3, 6, 12)) -> DataFrame:
    """Per admission cohort, share of spells not ended by a separation within k months."""
    aggs = [F.count(F.lit(1)).alias("admissoes")]
    for k in horizons:
        aggs.append(F.round(F.count_if(~(F.col("evento") & (F.col("duracao") < k))) / F.count(F.lit(1)), 6)
                    .alias(f"retencao_{k}m"))
    return spells.groupBy("coorte").agg(*aggs)


def mean_tenure(spells: DataFrame) -> DataFrame:
    """Mean months to separation over completed spells, per cohort."""
    return spells.where("evento").groupBy("coorte").agg(F.round(F.avg("duracao"), 6).alias("meses_ate_desligamento"),
                                                        F.count(F.lit(1)).alias("desligamentos"))


def lateness_counts(df: DataFrame, *, mov_month="competencia_mov", dec_month="competencia_dec") -> DataFrame:
    """Per month the sums that lateness is made of; they add up over arrivals, in a batch or in a stream."""
    lag = month_index(F.col(dec_month)) - month_index(F.col(mov_month))
    return (df.select(F.col(mov_month).alias("competencia"), lag.alias("atraso"))
            .groupBy("competencia").agg(
                F.count(F.lit(1)).alias("registros"), F.count_if(F.col("atraso") <= 0).alias("no_prazo"),
                F.count_if(F.col("atraso") > 0).alias("atrasados"), F.count("atraso").alias("medidos"),
                F.sum("atraso").alias("meses"), F.max("atraso").alias("atraso_max")))


def lateness_of(counts: DataFrame) -> DataFrame:
    """K3 from its sums."""
    return counts.select("competencia", "registros", "no_prazo", "atraso_max", F.round(F.col("meses") / F.col("medidos"), 6).alias("atraso_medio"),
                         F.round(F.col("atrasados") / F.col("registros") * 100.0, 6).alias("pct_atrasado"))


def lateness(df: DataFrame, *, mov_month="competencia_mov", dec_month="competencia_dec") -> DataFrame:
    """K3: months between declaration and movement; on-time flag; late share per month."""
    return lateness_of(lateness_counts(df, mov_month=mov_month, dec_month=dec_month))
