"""Balance and stock series over the movement view (slice 0 and family E1-E3, E12-E14, F1-F2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobflow.operators import balance as B
from jobflow.plans.registry import query
from jobflow.plans.sql import BAL, K, MOV, STOCK, dir_of, with_views
from jobflow.sources.tables import mov

BAL_COLS = ["competencia_mov", "tipo_movimentacao", "tipo", "saldo_movimentacao"]


def flagship(spark, sf_dir):
    """Monthly balance and anchored running stock."""
    return B.balance_series(mov(spark, sf_dir, BAL_COLS))


FLAGSHIP_SQL = with_views(MOV, K, BAL, STOCK) + "SELECT * FROM stock"

query("n2_balance", FLAGSHIP_SQL)(flagship)


@query("e1_balance_long", with_views(MOV, K) + """
SELECT competencia, m AS direction, CAST(sum(s) AS BIGINT) AS total_saldo, count(*) AS n_registros
FROM k WHERE m IS NOT NULL GROUP BY competencia, m""")
def e1(spark, sf_dir):
    return B.balance_long(mov(spark, sf_dir, BAL_COLS))


@query("e2_balance_pivot", with_views(MOV, K) + """
SELECT competencia, CAST(coalesce(sum(CASE WHEN m='A' THEN s END),0) AS BIGINT) AS admissoes,
 CAST(coalesce(sum(CASE WHEN m='D' THEN s END),0) AS BIGINT) AS desligamentos
FROM k WHERE m IS NOT NULL GROUP BY competencia""")
def e2(spark, sf_dir):
    return B.balance_pivot(mov(spark, sf_dir, BAL_COLS))


@query("e3_monthly_balance", with_views(MOV, K, BAL) + "SELECT * FROM bal")
def e3(spark, sf_dir):
    return B.monthly_balance(mov(spark, sf_dir, BAL_COLS))


@query("f1_stock", with_views(MOV, K, BAL, STOCK) + "SELECT competencia, saldo_mensal, estoque FROM stock")
def f1(spark, sf_dir):
    return B.running_stock(B.monthly_balance(mov(spark, sf_dir, BAL_COLS))).select(
        "competencia", "saldo_mensal", "estoque")


# F2 over the movement series restricted to months >= 202003, so the anchor month
# 202001 is absent and the baseline (test level) lands on the first month present.
@query("f2_stock_variant", with_views(MOV, K, BAL) + """,
b2 AS (SELECT * FROM bal WHERE competencia >= '202003'),
f AS (SELECT min(competencia) AS first_m FROM b2 WHERE competencia >= '202001')
SELECT competencia, saldo_mensal,
 CAST(sum(saldo_mensal + CASE WHEN competencia = (SELECT first_m FROM f) THEN 39567082 ELSE 0 END)
   OVER (ORDER BY competencia ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS estoque
FROM b2""")
def f2(spark, sf_dir):
    bal = B.monthly_balance(mov(spark, sf_dir, BAL_COLS)).where(F.col("competencia") >= "202003")
    return B.running_stock(bal, baseline=B.TEST_BASELINE, mode="first_on_or_after").select(
        "competencia", "saldo_mensal", "estoque")


@query("e12_summary", with_views(MOV, K, BAL, STOCK) + """
SELECT min(competencia) AS primeira, max(competencia) AS ultima, count(*) AS n_competencias,
 CAST(sum(admissoes) AS BIGINT) AS total_admissoes, CAST(sum(desligamentos) AS BIGINT) AS total_desligamentos,
 CAST(sum(saldo_mensal) AS BIGINT) AS saldo_total, CAST(arg_max(estoque, competencia) AS BIGINT) AS estoque_final
FROM stock""")
def e12(spark, sf_dir):
    return B.series_summary(flagship(spark, sf_dir))


@query("e13_sources", with_views(MOV) + f"""
SELECT competencia_mov AS competencia, CAST(count_if(tipo='MOV') AS BIGINT) AS n_mov, CAST(count_if(tipo='FOR') AS BIGINT) AS n_for,
 CAST(count_if(tipo='EXC') AS BIGINT) AS n_exc,
 CAST(count_if(tipo='EXC' AND ({dir_of()})='A') AS BIGINT) AS exc_admissoes,
 CAST(count_if(tipo='EXC' AND ({dir_of()})='D') AS BIGINT) AS exc_desligamentos,
 round(CAST(count_if(tipo='FOR') AS BIGINT) / count(*) * 100.0, 6) AS pct_fora_prazo
FROM mov GROUP BY competencia_mov""")
def e13(spark, sf_dir):
    return B.source_breakdown(mov(spark, sf_dir, BAL_COLS))


@query("e14_formula", with_views(MOV) + f""",
d AS (SELECT competencia_mov AS competencia, tipo, ({dir_of()}) AS m, abs(saldo_movimentacao) AS s FROM mov)
SELECT competencia,
 CAST(sum(CASE WHEN tipo<>'EXC' AND m='A' THEN s ELSE 0 END) AS BIGINT) AS adm,
 CAST(sum(CASE WHEN tipo<>'EXC' AND m='D' THEN s ELSE 0 END) AS BIGINT) AS desl,
 CAST(sum(CASE WHEN tipo='EXC' AND m='A' THEN s ELSE 0 END) AS BIGINT) AS exc_adm,
 CAST(sum(CASE WHEN tipo='EXC' AND m='D' THEN s ELSE 0 END) AS BIGINT) AS exc_desl,
 CAST(sum(CASE WHEN tipo<>'EXC' AND m='A' THEN s ELSE 0 END) - sum(CASE WHEN tipo<>'EXC' AND m='D' THEN s ELSE 0 END)
  + sum(CASE WHEN tipo='EXC' AND m='D' THEN s ELSE 0 END) - sum(CASE WHEN tipo='EXC' AND m='A' THEN s ELSE 0 END) AS BIGINT) AS saldo_formula
FROM d WHERE m IS NOT NULL GROUP BY competencia""")
def e14(spark, sf_dir):
    return B.balance_by_formula(mov(spark, sf_dir, BAL_COLS))


@query("c18_unrecognized", with_views(MOV) + f"""
SELECT CAST(tipo_movimentacao AS STRING) AS codigo, count(*) AS n_registros
FROM mov WHERE ({dir_of()}) IS NULL GROUP BY tipo_movimentacao""")
def c18(spark, sf_dir):
    return B.unrecognized(mov(spark, sf_dir, ["tipo_movimentacao"]))


@query("b15_classify", with_views(MOV) + f"""
SELECT tipo_movimentacao, ({dir_of()}) AS direction, count(*) AS n_registros
FROM mov GROUP BY tipo_movimentacao, direction""")
def b15(spark, sf_dir):
    return (B.classify_movement(mov(spark, sf_dir, ["tipo_movimentacao"]))
            .groupBy("tipo_movimentacao", "direction").agg(F.count(F.lit(1)).alias("n_registros")))


@query("b18_invert", with_views(MOV) + """
SELECT tipo, CASE WHEN tipo='EXC' THEN -saldo_movimentacao ELSE saldo_movimentacao END AS saldo_movimentacao,
 count(*) AS n_registros FROM mov GROUP BY 1, 2""")
def b18(spark, sf_dir):
    m = B.invert_exclusions(mov(spark, sf_dir, ["tipo", "saldo_movimentacao"]))
    return m.groupBy("tipo", "saldo_movimentacao").agg(F.count(F.lit(1)).alias("n_registros"))


@query("h1_union", with_views(MOV) + """
SELECT tipo, competencia_mov, CAST(sum(CASE WHEN tipo='EXC' THEN -saldo_movimentacao ELSE saldo_movimentacao END) AS BIGINT) AS saldo,
 count(*) AS n_registros FROM mov GROUP BY tipo, competencia_mov""")
def h1(spark, sf_dir):
    m = mov(spark, sf_dir, ["tipo", "competencia_mov", "saldo_movimentacao"])
    parts = {t: m.where(F.col("tipo") == t).drop("tipo") for t in ("MOV", "EXC", "FOR")}
    u = B.union_sources(parts["MOV"], parts["EXC"], parts["FOR"])
    return u.groupBy("tipo", "competencia_mov").agg(
        F.sum("saldo_movimentacao").cast("bigint").alias("saldo"), F.count(F.lit(1)).alias("n_registros"))


@query("e3_exclusions_declared", with_views(MOV) + f""", kd AS (SELECT CASE WHEN tipo = 'EXC' THEN competencia_dec ELSE competencia_mov END AS competencia,
  {dir_of()} AS m, CASE WHEN tipo='EXC' THEN -saldo_movimentacao ELSE saldo_movimentacao END AS s FROM mov)
SELECT competencia, admissoes, desligamentos, admissoes - desligamentos AS saldo_mensal FROM (
 SELECT competencia, CAST(coalesce(sum(CASE WHEN m='A' THEN s END),0) AS BIGINT) AS admissoes,
  CAST(abs(coalesce(sum(CASE WHEN m='D' THEN s END),0)) AS BIGINT) AS desligamentos
 FROM kd WHERE m IS NOT NULL GROUP BY competencia)""")
def e3d(spark, sf_dir):
    """E3 with exclusions counted in the month they were declared."""
    return B.monthly_balance(mov(spark, sf_dir, BAL_COLS + ["competencia_dec"]), exclusion_month="declared")
