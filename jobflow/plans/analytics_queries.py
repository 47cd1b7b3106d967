"""Operation log (E19-E23), entity totals (E10), documented analytics (E24-E29) and lateness (K3)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from jobflow.operators import analytics as AN
from jobflow.operators import oplog as OL
from jobflow.operators import profiles as PR
from jobflow.plans.balance_queries import BAL_COLS, flagship
from jobflow.plans.registry import query
from jobflow.plans.sql import BAL, K, MOV, OPLOG, STOCK, dir_of, with_views
from jobflow.session import scratch_path
from jobflow.sources.tables import mov, oplog, table

OV = with_views(OPLOG)

# --- E19-E23 ----------------------------------------------------------------------------------------

_MET = """count(*) AS total, CAST(count_if(success) AS BIGINT) AS sucesso, CAST(count_if(NOT success) AS BIGINT) AS falhas, 
 CAST(sum(CAST(round(duration * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS duracao_total,
 CAST(sum(CAST(round(duration * 100) AS BIGINT)) AS DOUBLE) / count(duration) / 100.0 AS duracao_media,
 min(duration) AS duracao_min, max(duration) AS duracao_max,
 round(CAST(count_if(success) AS BIGINT) / count(*), 6) AS taxa_sucesso"""


@query("e19_op_metrics", OV + f"SELECT operation, {_MET} FROM oplog GROUP BY operation UNION ALL SELECT 'geral', {_MET} FROM oplog")
def e19(spark, sf_dir):
    return OL.op_metrics(oplog(spark, sf_dir))


LIMITS = {"click": 400.0, "view": 450.0, "error": 300.0, "signup": 480.0, "purchase": 350.0}
_LIM_SQL = ", ".join(f"('{k}', {v})" for k, v in LIMITS.items())


@query("e20_op_alerts", OV + f""", m AS (SELECT operation, count(*) AS total, round(CAST(count_if(success) AS BIGINT) / count(*), 6) AS taxa_sucesso
 FROM oplog GROUP BY operation), lim AS (SELECT * FROM (VALUES {_LIM_SQL}) t(operation, limite)),
s AS (SELECT o.operation, CAST(count_if(o.duration > l.limite) AS BIGINT) AS execucoes_lentas FROM oplog o JOIN lim l USING (operation) GROUP BY o.operation)
SELECT m.operation, total, taxa_sucesso, CASE WHEN total > 5 AND taxa_sucesso <= 0.5 THEN 'critico'
 WHEN total > 5 AND taxa_sucesso < 0.8 THEN 'alerta' ELSE 'ok' END AS nivel, coalesce(s.execucoes_lentas, 0) AS execucoes_lentas
FROM m LEFT JOIN s USING (operation)""")
def e20(spark, sf_dir):
    return OL.op_alerts(spark, oplog(spark, sf_dir), LIMITS)


REF = _dt.datetime(2024, 1, 20, 12, 0, 0)


@query("e21_recent", OV + """SELECT * FROM oplog WHERE ts >= TIMESTAMP '2024-01-10 12:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'
 AND (lower(operation) LIKE '%click%' OR lower(operation) LIKE '%rro%') ORDER BY ts DESC, op_id DESC""")
def e21(spark, sf_dir):
    return OL.recent_ops(oplog(spark, sf_dir), ref=REF, hours=240, operations=["CLICK", "rro"])


@query("e22_throughput", OV + """SELECT operation, itens, round(ok / itens * 100.0, 6) AS pct_sucesso, round(itens / segundos, 6) AS arquivos_por_s,
 round(mb / segundos, 6) AS mb_por_s, round(500 / (itens / segundos), 6) AS eta_s, (1 - ok / itens) * 100.0 > 20.0 AS alerta_falhas,
 segundos > 300.0 AS alerta_tempo, itens / segundos < 0.5 AS alerta_vazao
FROM (SELECT operation, count(*) AS itens, CAST(count_if(success) AS BIGINT) AS ok,
 CAST(sum(CAST(round(duration * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS segundos,
 sum(CAST(json_extract_string(details, '$.k') AS DOUBLE)) AS mb FROM oplog GROUP BY operation)""")
def e22(spark, sf_dir):
    return OL.throughput(oplog(spark, sf_dir), remaining_items=500)


CK_SQL = """ck AS (SELECT event_id AS id, CASE event_type WHEN 'purchase' THEN 'concluido' WHEN 'error' THEN 'falhou' ELSE 'pendente' END AS status,
 CASE WHEN user_id % 2 = 0 THEN 'mensal' ELSE 'anual' END AS tipo, ts FROM events)"""


def checkpoint_log(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"),
                    F.when(F.col("event_type") == "purchase", "concluido").when(F.col("event_type") == "error", "falhou")
                    .otherwise("pendente").alias("status"),
                    F.when(F.col("user_id") % 2 == 0, "mensal").otherwise("anual").alias("tipo"), "ts")


@query("e23_checkpoints", with_views(CK_SQL) + """SELECT 'status' AS dimensao, status AS valor, count(*) AS n, max(ts) AS mais_recente FROM ck GROUP BY status
UNION ALL SELECT 'tipo', tipo, count(*), max(ts) FROM ck GROUP BY tipo UNION ALL SELECT 'total', '*', count(*), max(ts) FROM ck""")
def e23(spark, sf_dir):
    return OL.checkpoint_summary(checkpoint_log(spark, sf_dir))


@query("e23_checkpoints_list", with_views(CK_SQL) + "SELECT * FROM ck WHERE status IN ('falhou') AND tipo IN ('mensal') "
       "ORDER BY ts DESC, id DESC")
def e23l(spark, sf_dir):
    return OL.checkpoints_filtered(checkpoint_log(spark, sf_dir), status=["falhou"], tipo=["mensal"])


# --- E10 ------------------------------------------------------------------------------------------------------

_E10 = [("total_entidades", "count(*)"), ("total_movimentacoes", "CAST(count_if(tipo = 'MOV') AS BIGINT)"),
        ("total_exclusoes", "CAST(count_if(tipo = 'EXC') AS BIGINT)"), ("total_fora_prazo", "CAST(count_if(tipo = 'FOR') AS BIGINT)"),
        ("total_admissoes", f"CAST(count_if(({dir_of()}) = 'A') AS BIGINT)"), ("total_desligamentos", f"CAST(count_if(({dir_of()}) = 'D') AS BIGINT)"),
        ("saldo_liquido", f"CAST(count_if(({dir_of()}) = 'A') AS BIGINT) - CAST(count_if(({dir_of()}) = 'D') AS BIGINT)"), ("total_ufs", "count(DISTINCT uf)")]


@query("e10_entity_ind", with_views(MOV) + " UNION ALL ".join(
    f"SELECT '{n}' AS indicador, CAST({e} AS DOUBLE) AS valor FROM mov" for n, e in _E10))
def e10(spark, sf_dir):
    return AN.entity_indicators(mov(spark, sf_dir, ["tipo", "tipo_movimentacao", "uf"]))


# --- E24-E27 ------------------------------------------------------------------------------------------------------

SEG_COLS = BAL_COLS + ["secao", "regiao", "uf", "idade", "origem_informacao", "municipio", "cpf", "cnpj", "horas_contratuais"]
_BAND = """CASE WHEN idade < 18 THEN 'ate_17' WHEN idade < 25 THEN '18_24' WHEN idade < 30 THEN '25_29' WHEN idade < 40 THEN '30_39'
 WHEN idade < 50 THEN '40_49' WHEN idade < 65 THEN '50_64' ELSE '65_mais' END"""
_SEG_DIMS = {"secao": "secao", "regiao": "CAST(regiao AS STRING)", "uf": "CAST(uf AS STRING)", "faixa_etaria": _BAND,
             "origem": "CAST(origem_informacao AS STRING)", "municipio": "CAST(municipio AS STRING)", "sexo": "CAST(cpf % 3 + 1 AS STRING)",
             "grau_instrucao": "CAST(cpf % 9 + 1 AS STRING)",
             "tipo_contrato": "CASE WHEN cnpj % 7 = 0 THEN 'intermitente' WHEN horas_contratuais < 25 THEN 'parcial' ELSE 'integral' END"}
_SEG_K = f"""sk AS (SELECT *, ({dir_of()}) AS m, CASE WHEN tipo='EXC' THEN -saldo_movimentacao ELSE saldo_movimentacao END AS s FROM mov)"""
_ADM = "CAST(coalesce(sum(CASE WHEN m='A' THEN s END), 0) AS BIGINT)"
_DES = "CAST(abs(coalesce(sum(CASE WHEN m='D' THEN s END), 0)) AS BIGINT)"


@query("e24_segments", with_views(MOV, _SEG_K) + " UNION ALL ".join(
    f"SELECT '{n}' AS dimensao, {e} AS valor, {_ADM} AS admissoes, {_DES} AS desligamentos, {_ADM} - {_DES} AS saldo "
    f"FROM sk WHERE m IS NOT NULL GROUP BY {e}" for n, e in _SEG_DIMS.items()))
def e24(spark, sf_dir):
    m = mov(spark, sf_dir, SEG_COLS)
    dims = {"secao": F.col("secao"), "regiao": F.col("regiao"), "uf": F.col("uf"),
            "faixa_etaria": AN.age_band(F.col("idade")), "origem": F.col("origem_informacao"), "municipio": F.col("municipio"),
            "sexo": F.col("cpf") % 3 + 1, "grau_instrucao": F.col("cpf") % 9 + 1,
            "tipo_contrato": AN.contract_type(F.col("cnpj") % 7 == 0, F.col("horas_contratuais"))}
    return AN.segments(m, dims)


@query("e24_cube", with_views(MOV, _SEG_K) + f"""SELECT CAST(regiao AS STRING) AS regiao, secao, {_ADM} AS admissoes, {_DES} AS desligamentos,
 {_ADM} - {_DES} AS saldo FROM sk WHERE m IS NOT NULL GROUP BY regiao, secao
UNION ALL SELECT CAST(regiao AS STRING), 'TOTAL', {_ADM}, {_DES}, {_ADM} - {_DES} FROM sk WHERE m IS NOT NULL GROUP BY regiao
UNION ALL SELECT 'TOTAL', secao, {_ADM}, {_DES}, {_ADM} - {_DES} FROM sk WHERE m IS NOT NULL GROUP BY secao
UNION ALL SELECT 'TOTAL', 'TOTAL', {_ADM}, {_DES}, {_ADM} - {_DES} FROM sk WHERE m IS NOT NULL""")
def e24c(spark, sf_dir):
    return AN.segment_cube(mov(spark, sf_dir, BAL_COLS + ["regiao", "secao"]), "regiao", "secao")


_CENTS = "CAST(round(salario * 100) AS BIGINT)"


@query("e25_mean_salary", with_views(MOV) + f"""SELECT competencia_mov,
 CASE WHEN count(CASE WHEN ({dir_of()}) = 'A' THEN {_CENTS} END) > 0 THEN CAST(sum(CASE WHEN ({dir_of()}) = 'A' THEN {_CENTS} END) AS DOUBLE)
   / count(CASE WHEN ({dir_of()}) = 'A' THEN {_CENTS} END) / 100.0 END AS salario_medio_admitidos,
 CASE WHEN count(CASE WHEN ({dir_of()}) = 'D' THEN {_CENTS} END) > 0 THEN CAST(sum(CASE WHEN ({dir_of()}) = 'D' THEN {_CENTS} END) AS DOUBLE)
   / count(CASE WHEN ({dir_of()}) = 'D' THEN {_CENTS} END) / 100.0 END AS salario_medio_desligados
FROM mov GROUP BY competencia_mov""")
def e25(spark, sf_dir):
    return AN.mean_salary(mov(spark, sf_dir, ["competencia_mov", "tipo_movimentacao", "salario"]))


@query("e26_turnover", with_views(MOV, K, BAL, STOCK) + """SELECT competencia, admissoes, desligamentos, estoque,
 round(CASE WHEN ((estoque - saldo_mensal) + estoque) / 2.0 <> 0 THEN (admissoes + desligamentos) / (((estoque - saldo_mensal) + estoque) / 2.0) END, 9)
 AS rotatividade FROM stock""")
def e26(spark, sf_dir):
    return AN.turnover(flagship(spark, sf_dir))


@query("e27_disparity", with_views(MOV) + f""", g AS (SELECT regiao, sum(CASE WHEN ({dir_of()}) = 'A' THEN {_CENTS} END) AS sal,
 CAST(count_if(({dir_of()}) = 'A') AS BIGINT) AS na, sum(CASE WHEN tipo='EXC' THEN -saldo_movimentacao ELSE saldo_movimentacao END) AS saldo
 FROM mov WHERE ({dir_of()}) IS NOT NULL GROUP BY regiao)
SELECT regiao, round(CAST(sal AS DOUBLE) / na / 100.0, 6) AS salario_medio_admitidos,
 round(((CAST(sal AS DOUBLE) / na / 100.0) / (CAST((SELECT sum(sal) FROM g) AS DOUBLE) / (SELECT sum(na) FROM g) / 100.0) - 1) * 100.0, 6)
 AS diferenca_salarial_pct, CAST(saldo AS BIGINT) AS saldo, round(saldo / (SELECT sum(saldo) FROM g) * 100.0, 6) AS participacao_saldo_pct FROM g""")
def e27(spark, sf_dir):
    return AN.disparity(mov(spark, sf_dir, BAL_COLS + ["regiao", "salario"]), "regiao")


# --- E28-E29 ----------------------------------------------------------------------------------------------------------

@query("e28_transitions", with_views(MOV) + """, st AS (SELECT DISTINCT cpf, competencia_mov, secao FROM mov),
p AS (SELECT secao, lag(secao) OVER (PARTITION BY cpf ORDER BY competencia_mov, secao) AS origem FROM st)
SELECT origem, secao AS destino, count(*) AS transicoes FROM p WHERE origem IS NOT NULL GROUP BY origem, secao""")
def e28(spark, sf_dir):
    return AN.transitions(mov(spark, sf_dir, ["cpf", "competencia_mov", "secao"]))


_MI = "(CAST(substr(competencia_mov,1,4) AS INTEGER) * 12 + CAST(substr(competencia_mov,5,2) AS INTEGER) - 1)"
SPELLS_SQL = f"""pm AS (SELECT cnpj, cpf, competencia_mov, bool_or(({dir_of()}) = 'A') AS adm, bool_or(({dir_of()}) = 'D') AS sep
 FROM mov GROUP BY cnpj, cpf, competencia_mov),
sp0 AS (SELECT cnpj, cpf, competencia_mov, adm, {_MI} AS mi,
 coalesce(CASE WHEN sep THEN {_MI} END, min(CASE WHEN sep THEN {_MI} END) OVER (PARTITION BY cnpj, cpf ORDER BY competencia_mov
   ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS s, max({_MI}) OVER (PARTITION BY cnpj, cpf) AS last_m FROM pm),
spells AS (SELECT cnpj, cpf, competencia_mov AS coorte, s IS NOT NULL AS evento, coalesce(s - mi, last_m - mi) AS duracao FROM sp0 WHERE adm)"""


def _spells(spark, sf_dir):
    return AN.tenure(mov(spark, sf_dir, ["cnpj", "cpf", "competencia_mov", "tipo_movimentacao"]))


@query("e29_tenure", with_views(MOV, SPELLS_SQL) + """SELECT coorte, round(avg(duracao), 6) AS meses_ate_desligamento, count(*) AS desligamentos
FROM spells WHERE evento GROUP BY coorte""")
def e29t(spark, sf_dir):
    return AN.mean_tenure(_spells(spark, sf_dir))


@query("e29_cohort", with_views(MOV, SPELLS_SQL) + """SELECT coorte, count(*) AS admissoes,
 round(CAST(count_if(NOT (evento AND duracao < 3)) AS BIGINT) / count(*), 6) AS retencao_3m, round(CAST(count_if(NOT (evento AND duracao < 6)) AS BIGINT) / count(*), 6) AS retencao_6m,
 round(CAST(count_if(NOT (evento AND duracao < 12)) AS BIGINT) / count(*), 6) AS retencao_12m FROM spells GROUP BY coorte""")
def e29c(spark, sf_dir):
    return AN.cohort_retention(_spells(spark, sf_dir))


@query("e29_kaplan_meier", with_views(MOV, SPELLS_SQL) + """, per AS (SELECT duracao, CAST(count_if(evento) AS BIGINT) AS eventos, CAST(count_if(NOT evento) AS BIGINT) AS censurados
 FROM spells GROUP BY duracao),
r AS (SELECT *, CAST(sum(eventos + censurados) OVER (ORDER BY duracao DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS em_risco FROM per),
q AS (SELECT *, 1 - eventos / em_risco AS q FROM r)
SELECT duracao, em_risco, eventos, censurados,
 round(CASE WHEN max(CASE WHEN q <= 0 THEN 1 ELSE 0 END) OVER (ORDER BY duracao ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 THEN 0.0
  ELSE exp(sum(CASE WHEN q > 0 THEN ln(q) ELSE 0.0 END) OVER (ORDER BY duracao ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END, 6)
 AS sobrevivencia FROM q""")
def e29k(spark, sf_dir):
    return AN.kaplan_meier(_spells(spark, sf_dir))


# --- K3 ----------------------------------------------------------------------------------------------------------------

_LAG = ("(CAST(substr(competencia_dec,1,4) AS INTEGER) * 12 + CAST(substr(competencia_dec,5,2) AS INTEGER)) - "
        "(CAST(substr(competencia_mov,1,4) AS INTEGER) * 12 + CAST(substr(competencia_mov,5,2) AS INTEGER))")


# --- E8 over any range, N4, N5 ---------------------------------------------------------------------------

SKETCHED = ["uf", "cnpj", "subclasse"]


@query("e8_distinct_years", with_views(MOV) + " UNION ALL ".join(
    f"SELECT substr(competencia_mov, 1, 4) AS ano, '{c}' AS coluna, count(DISTINCT {c}) AS distintos, true AS no_limite FROM mov GROUP BY 1" for c in SKETCHED))
def e8s(spark, sf_dir):
    """Years from the sketches of their months, held against exact counts: within four standard errors."""
    m = mov(spark, sf_dir, ["competencia_mov", *SKETCHED])
    path = scratch_path(spark, "sketches")
    PR.distinct_sketches(m, SKETCHED).write.parquet(path)
    year = F.substring("competencia", 1, 4)
    guess = PR.distinct_over(spark.read.parquet(path), SKETCHED, year, "ano")
    exact = m.groupBy(F.substring("competencia_mov", 1, 4).alias("ano")).agg(*[F.count_distinct(c).alias(c) for c in SKETCHED])
    exact = exact.unpivot(["ano"], SKETCHED, "coluna", "distintos")
    near = F.abs(F.col("distintos_estimados") - F.col("distintos")) <= 4 * 1.04 / 2 ** (PR.SKETCH_BITS / 2) * F.col("distintos")
    return exact.join(guess, ["ano", "coluna"]).select("ano", "coluna", "distintos", near.alias("no_limite"))


@query("n5_trend", with_views(MOV) + f""", m AS (SELECT uf, CAST(substr(competencia_mov, 1, 4) AS BIGINT) * 12 + CAST(substr(competencia_mov, 5, 2) AS BIGINT) AS t,
  sum(CASE WHEN tipo = 'EXC' THEN -saldo_movimentacao ELSE saldo_movimentacao END) AS y FROM mov WHERE {dir_of()} IS NOT NULL GROUP BY ALL),
x AS (SELECT uf, t - min(t) OVER (PARTITION BY uf) AS x, y FROM m),
r AS (SELECT uf, count(*) AS meses, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_r2(y, x) AS r2 FROM x GROUP BY uf)
SELECT uf, meses, round(b, 6) AS inclinacao, round(a, 6) AS nivel_inicial, round(r2, 6) AS r2,
 CASE WHEN b > 0.1 THEN 'alta' WHEN b < -0.1 THEN 'queda' ELSE 'estavel' END AS tendencia FROM r""")
def n5(spark, sf_dir):
    return PR.segment_trend(mov(spark, sf_dir, ["uf", *BAL_COLS]), "uf")


@query("n4_features", with_views(MOV) + f"""SELECT cnpj, CAST(count_if({dir_of()} = 'A') AS DOUBLE) AS admissoes, CAST(count_if({dir_of()} = 'D') AS DOUBLE) AS desligamentos,
 CAST(count(DISTINCT competencia_mov) AS DOUBLE) AS meses_ativos, sum(CAST(round(salario * 100) AS BIGINT)) / count(salario) / 100.0 AS salario_medio
FROM mov GROUP BY cnpj""")
def n4f(spark, sf_dir):
    return PR.company_features(mov(spark, sf_dir, ["cnpj", "competencia_mov", "tipo_movimentacao", "salario"]))


@query("n4_kmeans_profiles")
def n4(spark, sf_dir):
    """Groups of companies; no SQL says what k-means finds, so rows only (planted groups are tested)."""
    found = PR.company_profiles(n4f(spark, sf_dir), 5)
    return found.groupBy("perfil").agg(F.count("*").alias("empresas"), *[F.avg(c).alias(c) for c in PR.PROFILE_FEATURES])


@query("k3_lateness", with_views(MOV) + f"""SELECT competencia_mov AS competencia, count(*) AS registros, CAST(count_if(a <= 0) AS BIGINT) AS no_prazo,
 max(a) AS atraso_max, round(avg(a), 6) AS atraso_medio, round(CAST(count_if(a > 0) AS BIGINT) / count(*) * 100.0, 6) AS pct_atrasado
FROM (SELECT competencia_mov, {_LAG} AS a FROM mov) GROUP BY competencia_mov""")
def k3(spark, sf_dir):
    return AN.lateness(mov(spark, sf_dir, ["competencia_mov", "competencia_dec"]))
