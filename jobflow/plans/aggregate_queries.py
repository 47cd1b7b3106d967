"""Company balances, indicators, profiles, distinct/set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobflow.operators import aggregates as A
from jobflow.plans.registry import query
from jobflow.plans.sql import ESTAB, MOV, with_views
from jobflow.sources.tables import MOV_COLUMNS, estab, mov

BALANCE_COLS = ["cnpj", "competencia", "admitidos", "desligados", "saldo"]

# movement rows with nulls injected by rule (the driver tables have none)
MOVN_SQL = """movn AS (SELECT id, competencia_mov, tipo,
  CASE WHEN tipo_movimentacao = 'XX' THEN NULL ELSE tipo_movimentacao END AS tipo_movimentacao,
  saldo_movimentacao,
  CASE WHEN idade > 45 THEN NULL ELSE idade END AS idade,
  CASE WHEN municipio = 0 THEN NULL ELSE municipio END AS municipio,
  CASE WHEN regiao = 3 THEN NULL ELSE uf END AS uf,
  CASE WHEN secao LIKE 'STANDARD%' THEN NULL ELSE secao END AS secao,
  CASE WHEN horas_contratuais < 3 THEN NULL ELSE salario END AS salario,
  horas_contratuais, cnpj, cpf
 FROM mov)"""


_MOVN_NEEDS = {"municipio": ["municipio"], "uf": ["regiao", "uf"], "salario": ["horas_contratuais", "salario"]}


def movn(spark, sf_dir, cols):
    """The movement view with rule-made nulls, restricted to ``cols`` (and to the joins they need)."""
    need = sorted({n for c in cols for n in _MOVN_NEEDS.get(c, [c])})
    value = {
        "tipo_movimentacao": lambda: F.when(F.col("tipo_movimentacao") != "XX", F.col("tipo_movimentacao")),
        "idade": lambda: F.when(F.col("idade") <= 45, F.col("idade")),
        "municipio": lambda: F.when(F.col("municipio") != 0, F.col("municipio")),
        "uf": lambda: F.when(F.col("regiao") != 3, F.col("uf")),
        "secao": lambda: F.when(~F.col("secao").like("STANDARD%"), F.col("secao")),
        "salario": lambda: F.when(F.col("horas_contratuais") >= 3, F.col("salario")),
    }
    return mov(spark, sf_dir, need).select(*[value.get(c, lambda c=c: F.col(c))().alias(c) for c in cols])


@query("e4_company_balance", with_views(MOV, ESTAB) + """
SELECT cnpj, substr(competencia,1,4) AS ano, CAST(sum(admitidos) AS BIGINT) AS admissoes,
 CAST(sum(desligados) AS BIGINT) AS desligamentos, CAST(sum(saldo) AS BIGINT) AS saldo
FROM estab WHERE length(trim(cnpj)) > 0 GROUP BY cnpj, substr(competencia,1,4)""")
def e4(spark, sf_dir):
    e = estab(spark, sf_dir, BALANCE_COLS).withColumn("ano", F.substring("competencia", 1, 4))
    return A.company_balance(e, by=("cnpj", "ano"))


@query("e5_rollup_total", with_views(MOV, ESTAB) + """
SELECT cnpj, CAST(sum(admitidos) AS BIGINT) AS admissoes, CAST(sum(desligados) AS BIGINT) AS desligamentos,
 CAST(sum(saldo) AS BIGINT) AS saldo FROM estab WHERE length(trim(cnpj)) > 0 GROUP BY cnpj
UNION ALL
SELECT 'GERAL', CAST(sum(admitidos) AS BIGINT), CAST(sum(desligados) AS BIGINT), CAST(sum(saldo) AS BIGINT)
FROM estab WHERE length(trim(cnpj)) > 0""")
def e5(spark, sf_dir):
    return A.company_balance_with_total(estab(spark, sf_dir, BALANCE_COLS))


IND_SQL = """ind AS (SELECT competencia, ta AS total_admitidos, td AS total_desligados, ts AS total_saldo, n AS total_registros,
  ta - td AS saldo_liquido_calculado,
  round(CASE WHEN ta + td > 0 AND n > 0 THEN (ta + td) / 2 / n * 100 END, 6) AS taxa_rotatividade,
  round(CASE WHEN n > 0 THEN (ta - td) / n * 100 END, 6) AS taxa_crescimento_liquido,
  round(CASE WHEN td > 0 THEN ta / td END, 6) AS razao_admissao_desligamento,
  round(CASE WHEN n > 0 THEN (ta + td) / n END, 6) AS densidade_movimentacao,
  nuf AS total_ufs_distintas, ncn AS total_cnaes_distintas, nco AS total_cnpjs_distintos,
  round(CASE WHEN nco > 0 THEN n / nco END, 6) AS media_movimentacoes_por_cnpj
 FROM (SELECT competencia, CAST(sum(admitidos) AS DOUBLE) AS ta, CAST(sum(desligados) AS DOUBLE) AS td,
   CAST(sum(saldo) AS DOUBLE) AS ts, CAST(count(*) AS DOUBLE) AS n,
   CAST(count(DISTINCT uf) + max(CASE WHEN uf IS NULL THEN 1 ELSE 0 END) AS DOUBLE) AS nuf,
   CAST(count(DISTINCT secao) + max(CASE WHEN secao IS NULL THEN 1 ELSE 0 END) AS DOUBLE) AS ncn,
   CAST(count(DISTINCT CASE WHEN cnpj IS NOT NULL AND length(cnpj) > 0 THEN cnpj END) AS DOUBLE) AS nco
  FROM estab GROUP BY competencia) g)"""


def _ind(spark, sf_dir):
    return A.indicators(estab(spark, sf_dir))


@query("e6_ind_basic", with_views(MOV, ESTAB, IND_SQL) +
       "SELECT competencia, " + ", ".join(A.BASIC) + " FROM ind")
def e6(spark, sf_dir):
    return _ind(spark, sf_dir).select("competencia", *A.BASIC)


@query("e7_ind_advanced", with_views(MOV, ESTAB, IND_SQL) +
       "SELECT competencia, " + ", ".join(A.ADVANCED) + " FROM ind")
def e7(spark, sf_dir):
    return _ind(spark, sf_dir).select("competencia", *A.ADVANCED)


@query("e8_ind_segment", with_views(MOV, ESTAB, IND_SQL) +
       "SELECT competencia, " + ", ".join(A.SEGMENT) + " FROM ind")
def e8(spark, sf_dir):
    return _ind(spark, sf_dir).select("competencia", *A.SEGMENT)


@query("e9_ind_long", with_views(MOV, ESTAB, IND_SQL) + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT competencia, '{n}' AS indicador, CAST({n} AS DOUBLE) AS valor FROM ind"
    for n in A.BASIC + A.ADVANCED + A.SEGMENT) + ") WHERE valor IS NOT NULL AND NOT isnan(valor) AND abs(valor) < 'inf'::DOUBLE")
def e9(spark, sf_dir):
    return A.indicators_long(_ind(spark, sf_dir))


NULL_COLS = ["tipo_movimentacao", "idade", "municipio", "uf", "secao", "salario", "cnpj"]


@query("e15_null_profile", with_views(MOV, MOVN_SQL) + " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, CAST(count_if({c} IS NULL) AS BIGINT) AS nulos, count(*) AS total, "
    f"round(CAST(count_if({c} IS NULL) AS BIGINT) / count(*) * 100.0, 6) AS pct_nulos FROM movn" for c in NULL_COLS))
def e15(spark, sf_dir):
    return A.null_profile(movn(spark, sf_dir, NULL_COLS), NULL_COLS)


OUT_COLS = ["idade", "horas_contratuais", "salario"]


@query("e16_outliers", with_views(MOV) + ", b AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS q1, CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS q3 FROM mov"
    for c in OUT_COLS) + """), f AS (SELECT coluna, q1, q3, q3 - q1 AS iqr, q1 - 1.5*(q3-q1) AS limite_inferior,
 q3 + 1.5*(q3-q1) AS limite_superior FROM b)
SELECT f.*, o.outliers, o.total, round(o.outliers / o.total * 100.0, 6) AS pct_outliers FROM f JOIN (""" +
    " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, CAST(count_if({c} < (SELECT limite_inferior FROM f WHERE coluna='{c}') OR "
        f"{c} > (SELECT limite_superior FROM f WHERE coluna='{c}')) AS BIGINT) AS outliers, count(*) AS total FROM mov"
        for c in OUT_COLS) + ") o USING (coluna)")
def e16(spark, sf_dir):
    return A.iqr_outliers(mov(spark, sf_dir, OUT_COLS), OUT_COLS)


_MOV_TYPES = {"id": "bigint", "competencia_mov": "string", "competencia_dec": "string", "tipo": "string",
              "tipo_movimentacao": "string", "saldo_movimentacao": "int", "regiao": "int", "uf": "int", "cnpj": "bigint",
              "cpf": "bigint", "municipio": "bigint", "secao": "string", "subclasse": "string", "idade": "int",
              "horas_contratuais": "double", "salario": "double", "origem_informacao": "bigint"}
_ROW_TEXT = "concat(" + ", ".join(
    f"coalesce(CAST(length(CAST({c} AS STRING)) AS STRING) || '=' || CAST({c} AS STRING), '~')" for c in MOV_COLUMNS) + ")"


@query("e17_checksum", with_views(MOV) + f"""SELECT {len(MOV_COLUMNS)} AS colunas,
 sha256('{",".join(f"{c}:{_MOV_TYPES[c]}" for c in sorted(_MOV_TYPES))}') AS assinatura_tipos, count(*) AS linhas,
 CAST(sum(CAST(('0x' || substr(md5({_ROW_TEXT}), 1, 15)) AS BIGINT)) AS STRING) AS hash_linhas,
 CAST(sum({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in MOV_COLUMNS)}) AS BIGINT) AS nulos FROM mov""")
def e17(spark, sf_dir):
    return A.checksum(mov(spark, sf_dir))


@query("h3_distinct", with_views(MOV) + """SELECT count(*) AS total_linhas,
 (SELECT count(*) FROM (SELECT DISTINCT * FROM mov)) AS linhas_distintas,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM mov)) AS linhas_duplicadas FROM mov""")
def h3(spark, sf_dir):
    return A.duplicate_rows(mov(spark, sf_dir))


DUP_KEYS = ["cnpj", "cpf", "competencia_mov", "tipo"]


@query("h4_dup_keys", with_views(MOV) + """, g AS (SELECT cnpj, cpf, competencia_mov, tipo, count(*) AS n FROM mov GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS total_linhas, count(*) AS chaves_distintas, CAST(sum(n - 1) AS BIGINT) AS linhas_duplicadas,
 CAST(count_if(n > 1) AS BIGINT) AS chaves_repetidas FROM g""")
def h4(spark, sf_dir):
    return A.duplicate_keys(mov(spark, sf_dir, DUP_KEYS), DUP_KEYS)


@query("h5_months", with_views(MOV) + "SELECT DISTINCT competencia_mov AS competencia FROM mov")
def h5(spark, sf_dir):
    return A.periods(mov(spark, sf_dir, ["competencia_mov"]))
