"""Filter family C over the movement view."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobflow.functions.codes import UF_LETTERS
from jobflow.operators import filters as C
from jobflow.plans.registry import query
from jobflow.plans.sql import MOV, with_views
from jobflow.sources.tables import mov, table

CNAE_SQL = """cnae AS (SELECT DISTINCT p_brand AS classe_cnae,
  CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) % 3 = 0 THEN 0 ELSE 1 END AS situacao FROM part)"""
BRANDS = ["Brand#11", "Brand#22", "Brand#5"]
CEP_EXPR = "lpad(CAST((cnpj * 7919) % 100000000 AS STRING), 8, '0')"


def cnae_table(spark, sf_dir):
    """Industry classification derived from part: code = brand, status 0 for brands divisible by 3."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_brand").alias("classe_cnae"),
                    F.when(F.substring("p_brand", 7, 10).cast("int") % 3 == 0, 0).otherwise(1).alias("situacao")
                    ).distinct()


def _m(spark, sf_dir, *cols):
    return mov(spark, sf_dir, ["id", "competencia_mov", *cols])


@query("c1_cnae_codes", with_views(MOV) + "SELECT id, competencia_mov, subclasse FROM mov "
       "WHERE subclasse IN ('Brand#11','Brand#22','Brand#5')")
def c1(spark, sf_dir):
    return C.filter_cnae(_m(spark, sf_dir, "subclasse"), BRANDS)


@query("c2_cnae_semi", with_views(MOV, CNAE_SQL) + "SELECT id, competencia_mov, subclasse FROM mov "
       "WHERE subclasse IN (SELECT classe_cnae FROM cnae WHERE situacao = 1)")
def c2(spark, sf_dir):
    return C.filter_cnae_table(_m(spark, sf_dir, "subclasse"), cnae_table(spark, sf_dir))


@query("c15_cnae_stats", with_views(CNAE_SQL) + """SELECT count(*) AS total, CAST(count_if(situacao=1) AS BIGINT) AS selecionados,
 round(CAST(count_if(situacao=1) AS BIGINT) / count(*) * 100.0, 6) AS pct_selecionados FROM cnae""")
def c15(spark, sf_dir):
    return C.cnae_stats(cnae_table(spark, sf_dir))


@query("a17_cnae_codes", with_views(CNAE_SQL) + "SELECT DISTINCT classe_cnae AS code FROM cnae WHERE situacao = 1")
def a17(spark, sf_dir):
    return C.cnae_codes(cnae_table(spark, sf_dir))


@query("c3_years", with_views(MOV) + "SELECT id, competencia_mov FROM mov WHERE substr(competencia_mov,1,4) IN ('2021','2023')")
def c3(spark, sf_dir):
    return C.filter_period(_m(spark, sf_dir), years=[2021, 2023])


@query("c4_months", with_views(MOV) + "SELECT id, competencia_mov FROM mov "
       "WHERE CAST(substr(competencia_mov,5,2) AS INTEGER) IN (1, 6, 12)")
def c4(spark, sf_dir):
    return C.filter_period(_m(spark, sf_dir), months=[1, 6, 12])


@query("c5_range", with_views(MOV) + """SELECT id, competencia_mov FROM mov
WHERE CAST(strptime(competencia_mov || '01', '%Y%m%d') AS DATE) >= DATE '2021-03-15'
  AND CAST(strptime(competencia_mov || '01', '%Y%m%d') AS DATE) <= DATE '2022-02-28'""")
def c5(spark, sf_dir):
    return C.filter_period(_m(spark, sf_dir), start="2021-03-15", end="2022-02-28")


@query("c6_types", with_views(MOV) + "SELECT id, competencia_mov, tipo_movimentacao FROM mov "
       "WHERE tipo_movimentacao IN ('10','31','99')")
def c6(spark, sf_dir):
    return C.filter_movement(_m(spark, sf_dir, "tipo_movimentacao"), types=[10, 31, 99])


@query("c7_admissions", with_views(MOV) + "SELECT id, competencia_mov, saldo_movimentacao FROM mov WHERE saldo_movimentacao > 0")
def c7(spark, sf_dir):
    return C.filter_movement(_m(spark, sf_dir, "saldo_movimentacao"), only="admissions")


@query("c8_separations", with_views(MOV) + "SELECT id, competencia_mov, saldo_movimentacao FROM mov WHERE saldo_movimentacao < 0")
def c8(spark, sf_dir):
    return C.filter_movement(_m(spark, sf_dir, "saldo_movimentacao"), only="separations")


@query("c9_uf", with_views(MOV) + "SELECT id, competencia_mov, uf FROM mov WHERE uf IN (1, 3, 24)")
def c9(spark, sf_dir):
    return C.filter_geo(_m(spark, sf_dir, "uf"), ufs=[1, 3, 24])


_LETTERS = list(UF_LETTERS.values())


@query("c9_uf_text", with_views(MOV) + ", t AS (SELECT id, competencia_mov, list_extract([" + ", ".join(f"'{x}'" for x in _LETTERS) +
       "], uf + 1) AS uf FROM mov) SELECT * FROM t WHERE uf IN ('SP', 'AC', 'CE', 'PB')")
def c9t(spark, sf_dir):
    """States as two letters, asked for in either case."""
    m = _m(spark, sf_dir, "uf").withColumn("uf", F.get(F.array(*[F.lit(x) for x in _LETTERS]), F.col("uf")))
    return C.filter_geo(m, ufs=["sp", "AC", "ce", "Pb"])


@query("c10_region", with_views(MOV) + "SELECT id, competencia_mov, regiao FROM mov WHERE regiao IN (2, 5)")
def c10(spark, sf_dir):
    return C.filter_geo(_m(spark, sf_dir, "regiao"), regions=[2, 5])


@query("c11_municipality", with_views(MOV) + "SELECT id, competencia_mov, municipio FROM mov WHERE municipio IN (0, 13, 42)")
def c11(spark, sf_dir):
    return C.filter_geo(_m(spark, sf_dir, "municipio"), municipalities=[0, 13, 42])


@query("c12_cep", with_views(MOV) + f"""SELECT id, competencia_mov, cep FROM (SELECT id, competencia_mov, {CEP_EXPR} AS cep FROM mov)
WHERE cep LIKE '0%' OR cep LIKE '1_3%' OR cep = '10009616'""")
def c12(spark, sf_dir):
    m = _m(spark, sf_dir, "cnpj").select("id", "competencia_mov", F.expr(CEP_EXPR).alias("cep"))
    return C.filter_geo(m, ceps=["0*", "1?3*", "10009616"])  # the exact code is outside both wildcards


CHAIN_COLS = ["saldo_movimentacao", "regiao", "subclasse", "municipio", "cnpj", "idade"]
CHAIN_CEPS = ["0*", "1*"]


def _chain(spark, sf_dir):
    return (C.FilterChain()
            .period(years=[2021, 2022])
            .movement(only="admissions")
            .geo(regions=[1, 2, 3], municipalities=list(range(60)), ceps=CHAIN_CEPS)
            .cnae(BRANDS + ["Brand#7", "Brand#13", "Brand#31"])
            .cnae_table(C.cnae_codes(cnae_table(spark, sf_dir)))
            .ranges({"idade": {"min": 5, "max": 45}}))


def _chain_frame(spark, sf_dir):
    m = _m(spark, sf_dir, *CHAIN_COLS)
    return m.withColumn("cep", F.expr(CEP_EXPR))


CHAIN_STEPS = [("periodo", "substr(competencia_mov,1,4) IN ('2021','2022')"), ("admissoes", "saldo_movimentacao > 0"),
               ("regiao", "regiao IN (1,2,3)"), ("municipio", "municipio < 60"),
               ("cep", "(cep LIKE '0%' OR cep LIKE '1%')"),
               ("cnae", "subclasse IN ('Brand#11','Brand#22','Brand#5','Brand#7','Brand#13','Brand#31')"),
               ("cnae_tabela", "subclasse IN (SELECT classe_cnae FROM cnae WHERE situacao = 1)"),
               ("faixa_idade", "idade BETWEEN 5 AND 45")]
CHAIN_VIEWS = with_views(MOV, CNAE_SQL, f"mc AS (SELECT *, {CEP_EXPR} AS cep FROM mov)")


@query("c13_chain", CHAIN_VIEWS + "SELECT id, competencia_mov, saldo_movimentacao, regiao, subclasse, municipio, cnpj, idade, cep FROM mc WHERE "
       + " AND ".join(p for _, p in CHAIN_STEPS))
def c13(spark, sf_dir):
    return _chain(spark, sf_dir).apply(_chain_frame(spark, sf_dir))


_RUNNING = [" AND ".join(p for _, p in CHAIN_STEPS[:i]) or "TRUE" for i in range(len(CHAIN_STEPS) + 1)]


@query("c13_chain_report", CHAIN_VIEWS + ", " + "c AS (SELECT " + ", ".join(
    f"CAST(sum(CASE WHEN {w} THEN 1 ELSE 0 END) AS BIGINT) AS c{i}" for i, w in enumerate(_RUNNING)) + " FROM mc), s AS (" + " UNION ALL ".join(
    f"SELECT {i} AS passo, '{n}' AS filtro, c{i - 1} AS linhas_antes, c{i} AS linhas_depois, 'aplicado' AS situacao FROM c"
    for i, (n, _) in enumerate(CHAIN_STEPS, start=1)) + """)
SELECT passo, filtro, linhas_antes, linhas_depois, situacao, linhas_antes - linhas_depois AS removidas,
 round(CASE WHEN linhas_antes > 0 THEN (linhas_antes - linhas_depois) / linhas_antes * 100.0 ELSE 0.0 END, 6) AS pct_removidas FROM s""")
def c13r(spark, sf_dir):
    return _chain(spark, sf_dir).report(_chain_frame(spark, sf_dir))


@query("c16_range_rules", with_views(MOV) + "SELECT id, competencia_mov, idade, horas_contratuais FROM mov "
       "WHERE idade BETWEEN 10 AND 40 AND horas_contratuais >= 5")
def c16(spark, sf_dir):
    return C.range_rules(_m(spark, sf_dir, "idade", "horas_contratuais"),
                         {"idade": {"min": 10, "max": 40}, "horas_contratuais": {"min": 5}})


@query("c17_valid_key", "SELECT c_custkey, chave FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' "
       "ELSE c_name END AS chave FROM customer) WHERE chave IS NOT NULL AND length(trim(chave)) > 0")
def c17(spark, sf_dir):
    k = F.col("c_custkey") % 5
    key = F.when(k == 1, "").when(k == 2, "  ").when(k > 2, F.col("c_name"))
    return C.valid_key(table(spark, sf_dir, "customer").select("c_custkey", key.alias("chave")), "chave")
