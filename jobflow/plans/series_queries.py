"""Windows, calendar, joins, top-k and set operators over the derived views (F3-F8, M, D, G, H2/H7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobflow.functions import calendar as M
from jobflow.functions.codes import (
    DICTIONARIES,
    MOVEMENT_TYPE_LABELS,
    REGION_LABELS,
    UF_LETTERS,
    dictionary,
    movement_type_dim,
    region_dim,
)
from jobflow.operators import balance as B
from jobflow.operators import joins as D
from jobflow.operators import ranking as G
from jobflow.operators import windows as W
from jobflow.plans.balance_queries import BAL_COLS, FLAGSHIP_SQL, flagship
from jobflow.plans.registry import query
from jobflow.plans.sql import BAL, CATALOG, K, MOV, OPLOG, STOCK, dir_of, with_views
from jobflow.sources.tables import catalog, mov, oplog

SERIES = with_views(MOV, K, BAL, STOCK)


@query("f3_stock_by", with_views(MOV) + f""",
k3 AS (SELECT competencia_mov AS competencia, regiao, ({dir_of()}) AS m,
  CASE WHEN tipo='EXC' THEN -saldo_movimentacao ELSE saldo_movimentacao END AS s FROM mov),
b3 AS (SELECT competencia, regiao, adm - desl AS saldo_mensal FROM (SELECT competencia, regiao,
  CAST(coalesce(sum(CASE WHEN m='A' THEN s END),0) AS BIGINT) AS adm,
  CAST(abs(coalesce(sum(CASE WHEN m='D' THEN s END),0)) AS BIGINT) AS desl FROM k3 WHERE m IS NOT NULL GROUP BY competencia, regiao) g)
SELECT competencia, regiao, saldo_mensal, CAST(sum(saldo_mensal) OVER (PARTITION BY regiao ORDER BY competencia
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS estoque FROM b3""")
def f3(spark, sf_dir):
    bal = B.monthly_balance(mov(spark, sf_dir, BAL_COLS + ["regiao"]), by=["regiao"])
    return B.running_stock(bal, baseline=0, by=["regiao"]).select("competencia", "regiao", "saldo_mensal", "estoque")


@query("f4_ytd", SERIES + """SELECT competencia, saldo_mensal, CAST(sum(saldo_mensal) OVER (PARTITION BY substr(competencia,1,4)
 ORDER BY competencia ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS saldo_ano FROM stock""")
def f4(spark, sf_dir):
    return W.ytd(flagship(spark, sf_dir)).select("competencia", "saldo_mensal", "saldo_ano")


@query("f5_pct_change", SERIES + """SELECT competencia, estoque, admissoes,
 round(CASE WHEN lag(estoque) OVER w <> 0 THEN (estoque - lag(estoque) OVER w) / abs(lag(estoque) OVER w) * 100.0 END, 6) AS var_pct_estoque,
 round(CASE WHEN lag(admissoes) OVER w <> 0 THEN (admissoes - lag(admissoes) OVER w) / abs(lag(admissoes) OVER w) * 100.0 END, 6) AS var_pct_admissoes
FROM stock WINDOW w AS (ORDER BY competencia)""")
def f5(spark, sf_dir):
    s = W.pct_change(W.pct_change(flagship(spark, sf_dir), value="estoque"), value="admissoes")
    return s.select("competencia", "estoque", "admissoes", "var_pct_estoque", "var_pct_admissoes")


@query("f6_moving_avg", SERIES + """SELECT competencia, saldo_mensal,
 round(avg(saldo_mensal) OVER (ORDER BY competencia ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS media_movel_3 FROM stock""")
def f6(spark, sf_dir):
    return W.moving_avg(flagship(spark, sf_dir), 3).select("competencia", "saldo_mensal", "media_movel_3")


@query("f7_seasonality", SERIES + """, p AS (SELECT CAST(substr(competencia,5,2) AS INTEGER) AS mes, sum(admissoes) AS s, count(*) AS n
 FROM stock GROUP BY 1)
SELECT mes, round(s / n, 6) AS media_mes, round((SELECT sum(s) / sum(n) FROM p), 6) AS media_geral,
 round((s / n) / (SELECT sum(s) / sum(n) FROM p), 6) AS indice_sazonal FROM p""")
def f7(spark, sf_dir):
    return W.seasonality(flagship(spark, sf_dir))


@query("f8_month_gaps", with_views(MOV) + """, m AS (SELECT DISTINCT cnpj, CAST(strptime(competencia_mov || '01', '%Y%m%d') AS DATE) AS d FROM mov),
n AS (SELECT cnpj, d, lead(d) OVER (PARTITION BY cnpj ORDER BY d) AS nx FROM m)
SELECT cnpj, strftime(d + INTERVAL 1 MONTH, '%Y%m') AS inicio_lacuna, strftime(nx - INTERVAL 1 MONTH, '%Y%m') AS fim_lacuna,
 CAST(date_diff('month', d, nx) - 1 AS INTEGER) AS meses_faltantes FROM n WHERE date_diff('month', d, nx) > 1""")
def f8(spark, sf_dir):
    return W.month_gaps(mov(spark, sf_dir, ["cnpj", "competencia_mov"]), by=["cnpj"])


# --- M: calendar --------------------------------------------------------------------

@query("m1_calendar", with_views(MOV) + """SELECT strftime(d, '%Y%m') AS competencia FROM (
 SELECT unnest(generate_series(min(CAST(strptime(competencia_dec || '01', '%Y%m%d') AS DATE)),
   max(CAST(strptime(competencia_dec || '01', '%Y%m%d') AS DATE)), INTERVAL 1 MONTH)) AS d FROM mov)""")
def m1(spark, sf_dir):
    return M.calendar_of(mov(spark, sf_dir, ["competencia_dec"]).withColumnRenamed("competencia_dec", "competencia"))


@query("m2_available", with_views(CATALOG) + """SELECT DISTINCT regexp_extract(file_name, '(\\d{6})', 1) AS competencia
FROM catalog WHERE regexp_extract(file_name, '(\\d{6})', 1) LIKE '2021%'
 AND CAST(substr(regexp_extract(file_name, '(\\d{6})', 1), 5, 2) AS INTEGER) BETWEEN 1 AND 12""")
def m2(spark, sf_dir):
    return M.available_months(catalog(spark, sf_dir), 2021)


DENSE_SQL = with_views(MOV) + """, s AS (SELECT competencia_mov AS competencia, count(*) AS n_registros,
 CAST(sum(saldo_movimentacao) AS BIGINT) AS saldo FROM mov WHERE tipo = 'EXC' AND idade = 1 GROUP BY 1),
cal AS (SELECT strftime(d, '%Y%m') AS competencia FROM (SELECT unnest(generate_series(
  min(CAST(strptime(competencia_mov || '01', '%Y%m%d') AS DATE)), max(CAST(strptime(competencia_mov || '01', '%Y%m%d') AS DATE)),
  INTERVAL 1 MONTH)) AS d FROM mov))
SELECT cal.competencia, coalesce(s.n_registros, 0) AS n_registros, coalesce(s.saldo, 0) AS saldo
FROM cal LEFT JOIN s ON cal.competencia = s.competencia"""


@query("m3_densify", DENSE_SQL)
def m3(spark, sf_dir):
    m = mov(spark, sf_dir, ["competencia_mov", "tipo", "idade", "saldo_movimentacao"])
    s = (m.where((F.col("tipo") == "EXC") & (F.col("idade") == 1)).groupBy(F.col("competencia_mov").alias("competencia"))
         .agg(F.count(F.lit(1)).alias("n_registros"), F.sum("saldo_movimentacao").cast("bigint").alias("saldo")))
    cal = M.calendar_of(m.select(F.col("competencia_mov").alias("competencia")))
    return M.densify(s, cal, fill={"n_registros": 0, "saldo": 0})


# --- D: joins -----------------------------------------------------------------------------

_DIM_VALUES = ", ".join(f"('{c}', '{lbl}', '{d}')" for c, lbl, d in MOVEMENT_TYPE_LABELS)


@query("d1_decode", with_views(MOV) + f""", dim AS (SELECT * FROM (VALUES {_DIM_VALUES}) t(code, label, direction))
SELECT m.tipo_movimentacao, d.label AS tipo_movimentacao_label, count(*) AS n_registros
FROM mov m LEFT JOIN dim d ON m.tipo_movimentacao = d.code GROUP BY 1, 2""")
def d1(spark, sf_dir):
    m = D.decode(mov(spark, sf_dir, ["tipo_movimentacao"]), "tipo_movimentacao", movement_type_dim(spark))
    return m.groupBy("tipo_movimentacao", "tipo_movimentacao_label").agg(F.count(F.lit(1)).alias("n_registros"))


@query("d3_stale", with_views(CATALOG) + """, i AS (SELECT file_id, file_name, CAST(mtime AS DATE) AS mtime FROM catalog),
o AS (SELECT file_id, CAST(mtime AS DATE) + CAST(file_id % 5 - 2 AS INTEGER) AS out_mtime, size_bytes % 13 AS out_rows
 FROM catalog WHERE processed)
SELECT i.file_id, i.file_name, i.mtime, CASE WHEN o.file_id IS NULL THEN 'sem_saida' WHEN o.out_mtime < i.mtime THEN 'desatualizada'
 WHEN o.out_rows <= 0 THEN 'vazia' END AS motivo
FROM i LEFT JOIN o ON i.file_id = o.file_id
WHERE o.file_id IS NULL OR o.out_mtime < i.mtime OR o.out_rows <= 0""")
def d3(spark, sf_dir):
    cat = catalog(spark, sf_dir)
    inputs = cat.select("file_id", "file_name", F.to_date("mtime").alias("mtime"))
    outputs = cat.where("processed").select(
        "file_id", F.date_add(F.to_date("mtime"), (F.col("file_id") % 5 - 2).cast("int")).alias("out_mtime"),
        (F.col("size_bytes") % 13).alias("out_rows"))
    return D.stale_files(inputs, outputs)


# --- D3 by the match rule: names that state a state or not, outputs under other names --------------------

_LETTERS = list(UF_LETTERS.values())
_WORDS = {"MOV": "MOVIMENTACAO", "EXC": "EXCLUSAO", "FOR": "FORA_PRAZO"}
_LETTER = "list_extract([" + ", ".join(f"'{x}'" for x in _LETTERS) + "], uf + 1)"


@query("d3_match", with_views(CATALOG) + f""", c AS (SELECT file_id, substr(file_name, 1, 3) AS tipo, substr(file_name, 4, 6) AS comp,
  substr(file_name, 4, 4) AS ano, {_LETTER} AS sigla, CAST(mtime AS DATE) AS mtime, size_bytes, processed FROM catalog),
i AS (SELECT file_id, tipo, ano, substr(comp, 5, 2) AS mes, CASE WHEN file_id % 3 > 0 THEN sigla END AS uf, mtime,
  tipo || comp || '_' || CASE WHEN file_id % 3 > 0 THEN sigla || '_' ELSE '' END || CAST(file_id AS STRING) AS base FROM c),
w AS (SELECT *, CASE tipo WHEN 'MOV' THEN 'MOVIMENTACAO' WHEN 'EXC' THEN 'EXCLUSAO' ELSE 'FORA_PRAZO' END AS palavra FROM c
  WHERE processed AND file_id % 11 > 4 AND NOT (tipo = 'EXC' AND CAST(ano AS INTEGER) % 2 = 0)),
o AS (SELECT tipo, ano, CASE WHEN file_id % 5 < 3 THEN substr(comp, 5, 2) END AS mes,
  CASE WHEN file_id % 5 = 0 AND file_id % 3 > 0 OR file_id % 5 IN (1, 3) THEN sigla END AS uf,
  CASE file_id % 5 WHEN 0 THEN tipo || comp || '_' || CASE WHEN file_id % 3 > 0 THEN sigla || '_' ELSE '' END || CAST(file_id AS STRING)
   WHEN 1 THEN palavra || comp || '_' || sigla WHEN 2 THEN palavra || comp WHEN 3 THEN palavra || '_' || ano || '_' || sigla
   ELSE palavra || '_' || ano END AS base, mtime + CAST(file_id % 7 - 3 AS INTEGER) AS out_mtime, size_bytes % 13 AS out_rows FROM w),
p AS (SELECT i.file_id, i.base, i.mtime, o.base AS o_base, out_mtime, out_rows, CASE WHEN i.base = o.base THEN 1
   ELSE 5 - 2 * CAST(i.mes IS NOT NULL AND o.mes IS NOT NULL AS INTEGER) - CAST(i.uf IS NOT NULL AND o.uf IS NOT NULL AS INTEGER) END AS nivel
  FROM i JOIN o ON i.ano = o.ano AND i.tipo = o.tipo AND (i.mes = o.mes OR o.mes IS NULL) AND (i.uf = o.uf OR i.uf IS NULL OR o.uf IS NULL)),
b AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY out_rows > 0 DESC, nivel, out_mtime DESC, o_base DESC, out_rows DESC) = 1),
r AS (SELECT i.file_id, i.base || '.7z' AS file_name, CASE WHEN b.file_id IS NULL THEN 'sem_saida' WHEN b.out_rows <= 0 THEN 'vazia'
  WHEN b.out_mtime < i.mtime THEN 'desatualizada' END AS motivo, nivel, b.o_base || '.csv' AS saida FROM i LEFT JOIN b USING (file_id))
SELECT * FROM r WHERE motivo IS NOT NULL""")
def d3m(spark, sf_dir):
    cat, k = catalog(spark, sf_dir), F.col("file_id")
    tipo, comp, ano = F.substring("file_name", 1, 3), F.substring("file_name", 4, 6), F.substring("file_name", 4, 4)
    sigla = F.get(F.array(*[F.lit(x) for x in _LETTERS]), F.col("uf"))
    word = F.lit(_WORDS["FOR"])
    for t in ("MOV", "EXC"):
        word = F.when(tipo == t, _WORDS[t]).otherwise(word)
    under = F.lit("_")
    base = F.concat(tipo, comp, under, F.when(k % 3 > 0, F.concat(sigla, under)).otherwise(F.lit("")), k.cast("string"))
    inputs = cat.select("file_id", F.concat(base, F.lit(".7z")).alias("file_name"), F.to_date("mtime").alias("mtime"))
    case = k % 5
    other = (F.when(case == 0, base).when(case == 1, F.concat(word, comp, under, sigla)).when(case == 2, F.concat(word, comp))
             .when(case == 3, F.concat(word, under, ano, under, sigla)).otherwise(F.concat(word, under, ano)))
    made = cat.where(F.col("processed") & (k % 11 > 4) & ~((tipo == "EXC") & (ano.cast("int") % 2 == 0)))
    outputs = made.select(F.concat(other, F.lit(".csv")).alias("out_name"),
                          F.date_add(F.to_date("mtime"), (k % 7 - 3).cast("int")).alias("out_mtime"), (F.col("size_bytes") % 13).alias("out_rows"))
    return D.stale_by_match(inputs, outputs).select("file_id", "file_name", "motivo", "nivel", "saida")


@query("d4_new_periods", with_views(MOV, K, BAL) + """, cal AS (SELECT strftime(d, '%Y%m') AS competencia FROM (
 SELECT unnest(generate_series(min(CAST(strptime(competencia_dec || '01', '%Y%m%d') AS DATE)),
   max(CAST(strptime(competencia_dec || '01', '%Y%m%d') AS DATE)), INTERVAL 1 MONTH)) AS d FROM mov))
SELECT competencia FROM cal WHERE competencia NOT IN (SELECT competencia FROM bal)""")
def d4(spark, sf_dir):
    requested = M.calendar_of(mov(spark, sf_dir, ["competencia_dec"]).withColumnRenamed("competencia_dec", "competencia"))
    done = B.monthly_balance(mov(spark, sf_dir, BAL_COLS))
    return D.new_periods(requested, done)


PREF_COLS = ["id", "cnpj", "cpf", "competencia_mov", "tipo_movimentacao", "origem_informacao", "saldo_movimentacao", "salario"]
PREF_KEY = ["cnpj", "cpf", "competencia_mov", "tipo_movimentacao"]


@query("d5_prefer_source", with_views(MOV) + """SELECT id, cnpj, cpf, competencia_mov, tipo_movimentacao, origem_informacao,
 saldo_movimentacao, salario FROM (SELECT *, row_number() OVER (PARTITION BY cnpj, cpf, competencia_mov, tipo_movimentacao
 ORDER BY origem_informacao, id, saldo_movimentacao, salario) AS rn FROM mov) WHERE rn = 1""")
def d5(spark, sf_dir):
    return D.prefer_source(mov(spark, sf_dir, PREF_COLS), PREF_KEY, tiebreak=["id"]).select(*PREF_COLS)


IMP_COLS = ["id", "cnpj", "cpf", "competencia_mov", "tipo_movimentacao", "origem_informacao"]


@query("d6_impute", with_views(MOV) + f"""SELECT {', '.join(IMP_COLS)} FROM mov WHERE origem_informacao IN (1, 2)
UNION ALL
SELECT {', '.join(IMP_COLS)} FROM mov e WHERE origem_informacao = 3 AND ({dir_of('e.tipo_movimentacao')}) = 'D'
 AND NOT EXISTS (SELECT 1 FROM mov m WHERE m.origem_informacao IN (1, 2) AND m.cnpj = e.cnpj AND m.cpf = e.cpf
   AND m.competencia_mov = e.competencia_mov)""")
def d6(spark, sf_dir):
    m = mov(spark, sf_dir, IMP_COLS)
    return D.impute_separations_in(m, key=["cnpj", "cpf", "competencia_mov"],
                                   is_main=F.col("origem_informacao").isin(1, 2)).select(*IMP_COLS)


# --- H2 / H7 --------------------------------------------------------------------------------

query("h2_append_recalc", FLAGSHIP_SQL)(lambda spark, sf_dir: _h2(spark, sf_dir))


def _h2(spark, sf_dir):
    """Old series = months before 2024 (as stored earlier); new months computed separately."""
    m = mov(spark, sf_dir, BAL_COLS)
    old = B.balance_series(m.where(F.col("competencia_mov") < "202401"))
    new = B.monthly_balance(m.where(F.col("competencia_mov") >= "202401"))
    return B.append_recalc(old, new)


@query("h7_available", with_views(MOV) + """SELECT DISTINCT competencia_mov AS competencia FROM mov
WHERE competencia_mov BETWEEN '201901' AND '202112'""")
def h7(spark, sf_dir):
    requested = M.calendar(spark, "201901", "202112")
    present = mov(spark, sf_dir, ["competencia_mov"]).select(F.col("competencia_mov").alias("competencia"))
    return D.available(requested, present)


# --- G: top-k ----------------------------------------------------------------------------------

@query("g3_head_tail", SERIES + """SELECT * FROM (SELECT *, 'inicio' AS posicao FROM stock ORDER BY competencia LIMIT 5)
UNION ALL SELECT * FROM (SELECT *, 'fim' AS posicao FROM stock ORDER BY competencia DESC LIMIT 5)""")
def g3(spark, sf_dir):
    return G.head_tail(flagship(spark, sf_dir))


EX_COLS = ["id", "competencia_mov", "tipo", "tipo_movimentacao", "saldo_movimentacao", "cnpj", "cpf", "salario",
           "horas_contratuais"]


@query("g4_examples", with_views(MOV) + f"SELECT {', '.join(EX_COLS)} FROM mov WHERE tipo_movimentacao = 'XX' "
       f"ORDER BY {', '.join(EX_COLS)} LIMIT 3")
def g4(spark, sf_dir):
    return G.examples(mov(spark, sf_dir, EX_COLS), F.col("tipo_movimentacao") == "XX", 3)


@query("g5_largest", with_views(CATALOG) + "SELECT * FROM catalog ORDER BY size_bytes DESC, file_name LIMIT 10")
def g5(spark, sf_dir):
    return G.largest(catalog(spark, sf_dir), 10)


@query("g6_topk_group", with_views(MOV) + """, a AS (SELECT substr(competencia_mov,1,4) AS ano, competencia_mov AS competencia,
 count(*) AS n FROM mov GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ano ORDER BY n DESC, competencia) AS INTEGER) AS rank FROM a) WHERE rank <= 3""")
def g6(spark, sf_dir):
    a = (mov(spark, sf_dir, ["competencia_mov"])
         .groupBy(F.substring("competencia_mov", 1, 4).alias("ano"), F.col("competencia_mov").alias("competencia"))
         .agg(F.count(F.lit(1)).alias("n")))
    return G.topk_per_group(a, ["ano"], "n", 3, tie=["competencia"])


@query("g6_topk_uf", with_views(MOV) + """, a AS (SELECT substr(competencia_mov,1,4) AS ano, uf, count(*) AS n FROM mov GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ano ORDER BY n DESC, uf) AS INTEGER) AS rank FROM a) WHERE rank <= 5""")
def g6u(spark, sf_dir):
    a = (mov(spark, sf_dir, ["competencia_mov", "uf"])
         .groupBy(F.substring("competencia_mov", 1, 4).alias("ano"), "uf").agg(F.count(F.lit(1)).alias("n")))
    return G.topk_per_group(a, ["ano"], "n", 5, tie=["uf"])


@query("g7_slowest", with_views(OPLOG) + """SELECT * FROM oplog WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'
 AND ts <= TIMESTAMP '2024-01-20 00:00:00' ORDER BY duration DESC, op_id LIMIT 5""")
def g7(spark, sf_dir):
    return G.slowest(oplog(spark, sf_dir), 5, since="2024-01-10 00:00:00", until="2024-01-20 00:00:00")


_REGION_VALUES = ", ".join(f"({c}, '{lbl}')" for c, lbl in REGION_LABELS)


@query("d1_decode_region", with_views(MOV) + f""", dim AS (SELECT * FROM (VALUES {_REGION_VALUES}) t(code, label))
SELECT m.regiao, d.label AS regiao_label, count(*) AS n_registros FROM mov m LEFT JOIN dim d ON m.regiao = d.code GROUP BY 1, 2""")
def d1r(spark, sf_dir):
    m = D.decode(mov(spark, sf_dir, ["regiao"]), "regiao", region_dim(spark))
    return m.groupBy("regiao", "regiao_label").agg(F.count(F.lit(1)).alias("n_registros"))


def _decode_sql(source: str, name: str) -> str:
    """Counts per code and label of a derived code column ``source`` under dictionary ``name``."""
    values = ", ".join(f"({c}, '{label}')" for c, label in DICTIONARIES[name])
    return (with_views(MOV) + f", dim AS (SELECT * FROM (VALUES {values}) t(code, label)), c AS (SELECT CAST({source} AS INTEGER) AS codigo FROM mov) "
            "SELECT c.codigo, d.label AS codigo_label, count(*) AS n_registros FROM c LEFT JOIN dim d ON c.codigo = d.code GROUP BY 1, 2")


# codes of every dictionary, some of them unknown to it, from columns of the movement view
DECODED = {
    "uf": "uf + 11", "sexo": "cpf % 3 + 1", "grau_instrucao": "cpf % 11 + 1", "raca_cor": "cpf % 7", "categoria": "100 + cpf % 13",
    "tipo_empregador": "cnpj % 4", "tipo_estabelecimento": "cnpj % 6", "tamanho_estabelecimento": "cnpj % 11",
    "tipo_deficiencia": "cpf % 10", "unidade_salario": "cpf % 8", "origem_informacao": "origem_informacao",
    "indicador_aprendiz": "cpf % 4", "indicador_exclusao": "cnpj % 3", "indicador_fora_prazo": "cpf % 3",
    "indicador_trabalho_intermitente": "cpf % 5", "indicador_trabalho_parcial": "cnpj % 5",
}


def _decode_key(name: str, source: str) -> None:
    def run(spark, sf_dir):
        codes = mov(spark, sf_dir, ["cpf", "cnpj", "uf", "origem_informacao"]) if name == "uf" else \
            mov(spark, sf_dir, ["cpf", "cnpj", "origem_informacao"])
        m = D.decode(codes.select(F.expr(source).cast("int").alias("codigo")), "codigo", dictionary(spark, name))
        return m.groupBy("codigo", "codigo_label").agg(F.count(F.lit(1)).alias("n_registros"))

    query(f"d1_decode_{name}", _decode_sql(source, name))(run)


for _name, _source in DECODED.items():
    _decode_key(_name, _source)
