"""Name harmonisation, value cleaning and entity projections (B family, A3, A14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobflow.functions import clean as CL
from jobflow.functions import names as NM
from jobflow.operators import entities as EN
from jobflow.plans.balance_queries import FLAGSHIP_SQL, flagship
from jobflow.plans.quality_queries import MOVQ_SQL, movq
from jobflow.plans.registry import query
from jobflow.plans.sql import MOV, dir_of, with_views
from jobflow.sources.tables import mov, table

# --- B1 ----------------------------------------------------------------------------------------


@query("b1_normalize_text", r"""SELECT doc_id, CASE WHEN t = '' THEN 'COLUNA_SEM_NOME' ELSE t END AS texto_normalizado FROM (
 SELECT doc_id, regexp_replace(regexp_replace(replace(upper(trim(regexp_replace(regexp_replace(strip_accents(trim(text)),
   '[^a-zA-Z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))), ' ', '_'), '_+', '_', 'g'), '^_+|_+$', '', 'g') AS t FROM documents)""")
def b1(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", CL.normalize_text(F.col("text")).alias("texto_normalizado"))


# --- B2-B4, B8-B10: names ------------------------------------------------------------------------

RAW_NAMES = {"competencia_mov": "competênciamov", "regiao": "região", "uf": "uf", "municipio": "município",
             "secao": "seção", "subclasse": "subclasse", "saldo_movimentacao": "saldomovimentação",
             "tipo_movimentacao": "tipomovimentação", "idade": "idade", "horas_contratuais": "horascontratuais",
             "salario": "salário", "origem_informacao": "origemdainformação"}


def raw_layout(spark, sf_dir):
    """Movement rows with the published layout's raw (accented, unseparated) header names."""
    m = mov(spark, sf_dir, list(RAW_NAMES) + ["cnpj"])
    return m.select(*[F.col(k).alias(v) for k, v in RAW_NAMES.items()],
                    F.lit(1).alias("unidadesaláriocódigo"), F.col("municipio").alias("Código do Município"))


@query("b2_canonical_names", with_views(MOV) + """SELECT competencia_mov AS COMPETENCIA_MOV, regiao AS REGIAO, uf AS UF,
 municipio AS MUNICIPIO, secao AS SECAO, subclasse AS SUBCLASSE, saldo_movimentacao AS SALDO_MOVIMENTACAO,
 tipo_movimentacao AS TIPO_MOVIMENTACAO, idade AS IDADE, horas_contratuais AS HORAS_CONTRATUAIS, salario AS SALARIO,
 origem_informacao AS ORIGEM_INFORMACAO, 1 AS UNIDADE_SALARIO_CODIGO, municipio AS MUNICIPIO_2 FROM mov""")
def b2(spark, sf_dir):
    return NM.canonical_names(raw_layout(spark, sf_dir))


ALIAS_NAMES = {"uf": "Estado", "municipio": "Cidade", "idade": "Idade do Trabalhador", "competencia_mov": "Competência",
               "saldo_movimentacao": "Valor da movimentação", "origem_informacao": "Origem", "secao": "Seção CNAE",
               "subclasse": "CNAE Subclasse"}


# raw names that must not be taken for a field they merely contain, and names that are one by whole words
SIMILAR = {"cnpj": "Quantidade", "cpf": "Nacionalidade", "municipio": "Localidade", "idade": "Modalidade", "secao": "Intersecao",
           "uf": "UF Residência", "regiao": "Região de Origem", "horas_contratuais": "Horas", "salario": "Valor do Salário Fixo Mensal",
           "saldo_movimentacao": "Instrução", "tipo": "Cidade Natal", "competencia_mov": "Competência Mov."}


@query("b5_similarity", with_views(MOV) + """SELECT cnpj AS QUANTIDADE, cpf AS NACIONALIDADE, municipio AS LOCALIDADE, idade AS MODALIDADE,
 secao AS INTERSECAO, uf AS UF_RESIDENCIA, regiao AS REGIAO, horas_contratuais AS HORAS, salario AS VALOR_SALARIO_FIXO,
 saldo_movimentacao AS GRAU_INSTRUCAO, tipo AS CIDADE_NATAL, competencia_mov AS COMPETENCIA_MOV FROM mov""")
def b5(spark, sf_dir):
    return NM.canonical_names(mov(spark, sf_dir, list(SIMILAR)).select(*[F.col(c).alias(n) for c, n in SIMILAR.items()]))


FIELD_GROUPS = {"competencia": ["COMPETENCIA_MOV", "COMPETENCIA", "ANO_MES"], "municipio": ["MUNICIPIO", "CIDADE"],
                "saldo_movimentacao": ["SALDO_MOVIMENTACAO", "SALDO"], "faixa_etaria": ["FAIXA_ETARIA", "IDADE"]}


@query("b5_map_fields", with_views(MOV) + """SELECT competencia_mov AS COMPETENCIA, competencia_dec AS COMPETENCIA_1, municipio AS MUNICIPIO,
 saldo_movimentacao AS SALDO_MOVIMENTACAO, idade AS FAIXA_ETARIA, cnpj AS QUANTIDADE FROM mov""")
def b5m(spark, sf_dir):
    raw = {"competencia_mov": "Competência", "competencia_dec": "Ano/Mês", "municipio": "Cidade Natal", "saldo_movimentacao": "saldo",
           "idade": "Idade", "cnpj": "Quantidade"}
    m = mov(spark, sf_dir, list(raw))
    return m.toDF(*NM.map_fields(list(raw.values()), FIELD_GROUPS))


@query("b4_alias_names", with_views(MOV) + """SELECT uf AS UF, municipio AS MUNICIPIO, idade AS IDADE,
 competencia_mov AS COMPETENCIA_MOV, saldo_movimentacao AS SALDO_MOVIMENTACAO, origem_informacao AS ORIGEM_INFORMACAO,
 secao AS SECAO, subclasse AS SUBCLASSE FROM mov""")
def b4(spark, sf_dir):
    m = mov(spark, sf_dir, list(ALIAS_NAMES))
    return NM.canonical_names(m.select(*[F.col(k).alias(v) for k, v in ALIAS_NAMES.items()]))


@query("b8_select_known", with_views(MOV) + "SELECT cnpj, competencia_mov FROM mov")
def b8(spark, sf_dir):
    return NM.select_known(mov(spark, sf_dir, ["id", "cnpj", "competencia_mov", "tipo"]),
                           ["cnpj", "competencia_mov", "nao_existe"])


@query("b9_with_period", with_views(MOV) + """SELECT id, competencia_mov AS COMPETENCIA_MOV,
 substr(competencia_mov,1,4) || '-' || substr(competencia_mov,5,2) AS ANO_MES,
 CAST(substr(competencia_mov,1,4) AS INTEGER) AS ANO, CAST(substr(competencia_mov,5,2) AS INTEGER) AS MES FROM mov""")
def b9(spark, sf_dir):
    m = mov(spark, sf_dir, ["id", "competencia_mov"]).withColumnRenamed("competencia_mov", "COMPETENCIA_MOV")
    return NM.with_period(m)


_ALIGN_SRC = {"COMPETENCIA_MOV": "competencia_mov", "REGIAO": "regiao", "UF": "uf", "MUNICIPIO": "municipio",
              "SECAO": "secao", "SUBCLASSE": "subclasse", "SALDO_MOVIMENTACAO": "saldo_movimentacao", "IDADE": "idade",
              "HORAS_CONTRATUAIS": "horas_contratuais", "TIPO_MOVIMENTACAO": "tipo_movimentacao", "SALARIO": "salario",
              "ORIGEM_INFORMACAO": "origem_informacao", "COMPETENCIA_DEC": "competencia_dec"}


def _align_sql_col(c):
    if c in _ALIGN_SRC:
        return f"{_ALIGN_SRC[c]} AS {c}"
    if c in NM.INT_DEFAULT_COLUMNS:
        return f"CAST(0 AS INTEGER) AS {c}"
    if c in NM.FLOAT_DEFAULT_COLUMNS:
        return f"CAST(0.0 AS DOUBLE) AS {c}"
    return f"'' AS {c}"


@query("b10_align", with_views(MOV) + "SELECT " + ", ".join(_align_sql_col(c) for c in NM.STANDARD_COLUMNS) + " FROM mov")
def b10(spark, sf_dir):
    return NM.align(NM.canonical_names(mov(spark, sf_dir)))


# --- B11-B13, B17: values ---------------------------------------------------------------------------

INFER_COLS = ["periodo", "sexo", "classe", "cbo", "horas_txt", "mes_txt", "subclasse_cnae"]


@query("b11_infer_types", with_views(MOV, MOVQ_SQL) + " UNION ALL ".join(
    rf"""SELECT '{c}' AS coluna, CAST(count_if({c} IS NOT NULL AND NOT regexp_matches({c}, '^-?\d+$')) AS BIGINT) AS n_nao_int,
 CAST(count_if({c} IS NOT NULL AND NOT regexp_matches({c}, '^-?\d+(\.\d+)?$')) AS BIGINT) AS n_nao_float,
 CASE WHEN CAST(count_if({c} IS NOT NULL AND NOT regexp_matches({c}, '^-?\d+$')) AS BIGINT) = 0 THEN 'int'
      WHEN CAST(count_if({c} IS NOT NULL AND NOT regexp_matches({c}, '^-?\d+(\.\d+)?$')) AS BIGINT) = 0 THEN 'float' ELSE 'text' END AS tipo_inferido
 FROM movq""" for c in INFER_COLS))
def b11(spark, sf_dir):
    return CL.infer_types(movq(spark, sf_dir, INFER_COLS), INFER_COLS)


NAMED = {"CNPJ_RAIZ": "classe", "TOTAL_HORAS": "CASE WHEN id % 50 = 0 THEN NULL ELSE horas_txt END", "VALOR_HORA": "mes_txt || '.5'",
         "SALARIO": "mes_txt", "SALDO": "horas_txt", "QUANTIDADE": "'9' || lpad(mes_txt, 19, '9')", "PERIODO": "mes_txt",
         "IDADE": "CASE WHEN id < 0 THEN '1' END"}
_WANTED = {"CNPJ_RAIZ": "text", "TOTAL_HORAS": "int", "VALOR_HORA": "int", "SALARIO": "float", "SALDO": "int", "QUANTIDADE": "int",
           "PERIODO": "text", "IDADE": "int"}


@query("b11_types_by_name", with_views(MOV, MOVQ_SQL) + ", n AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in NAMED.items()) + " FROM movq) "
       + " UNION ALL ".join(rf"""SELECT '{c}' AS coluna, CAST(coalesce(count_if({c} IS NOT NULL AND (TRY_CAST({c} AS BIGINT) IS NULL OR contains({c}, '.'))), 0) AS BIGINT) AS n_nao_int,
 CAST(coalesce(count_if({c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL), 0) AS BIGINT) AS n_nao_float,
 CASE WHEN '{w}' = 'text' OR count({c}) = 0 THEN 'text'
  WHEN '{w}' = 'int' AND count_if({c} IS NOT NULL AND (TRY_CAST({c} AS BIGINT) IS NULL OR contains({c}, '.'))) = 0 THEN 'int'
  WHEN count_if({c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) = 0 THEN 'float' ELSE 'text' END AS tipo_inferido FROM n"""
                            for c, w in _WANTED.items()))
def b11n(spark, sf_dir):
    q = movq(spark, sf_dir, ["id", "classe", "horas_txt", "mes_txt"])
    return CL.infer_types(q.select(*[F.expr(e).alias(c) for c, e in NAMED.items()]), list(NAMED), by_name=True)


RAW_INT = """CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '-' WHEN 2 THEN '000'
 ELSE CAST(user_id AS STRING) || '-' || CAST(event_id % 10 AS STRING) END"""


@query("b12a_clean_int", rf"""SELECT event_id, bruto, coalesce(TRY_CAST(CASE WHEN regexp_matches(t, '^-*$') OR regexp_matches(t, '^0+$')
 THEN '0' ELSE t END AS BIGINT), 0) AS valor FROM (SELECT event_id, bruto, regexp_replace(bruto, '[^0-9-]', '', 'g') AS t
 FROM (SELECT event_id, {RAW_INT} AS bruto FROM events))""")
def b12a(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.expr(RAW_INT).alias("bruto"))
    return e.withColumn("valor", CL.clean_int(F.col("bruto")))


RAW_MONEY = """CASE o_orderkey % 4
 WHEN 0 THEN substr(s, 1, length(s) - 2) || ',' || substr(s, length(s) - 1)
 WHEN 1 THEN substr(s, 1, length(s) - 2) || '.' || substr(s, length(s) - 1)
 WHEN 2 THEN 'R$ ' || substr(s, 1, length(s) - 2) || ',' || substr(s, length(s) - 1)
 ELSE CASE WHEN length(s) > 5 THEN substr(s, 1, length(s) - 5) || '.' || substr(s, length(s) - 4, 3) || ',' || substr(s, length(s) - 1)
      ELSE substr(s, 1, length(s) - 2) || ',' || substr(s, length(s) - 1) END END"""
MONEY_S = "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS STRING)"


@query("b12b_clean_float", rf"""SELECT o_orderkey, bruto, coalesce(TRY_CAST(CASE WHEN t2 = '' THEN '0' ELSE t2 END AS DOUBLE), 0.0) AS valor
FROM (SELECT o_orderkey, bruto, CASE WHEN contains(t, ',') THEN replace(replace(t, '.', ''), ',', '.') ELSE t END AS t2
 FROM (SELECT o_orderkey, bruto, regexp_replace(bruto, '[^0-9.,-]', '', 'g') AS t
  FROM (SELECT o_orderkey, {RAW_MONEY} AS bruto FROM (SELECT o_orderkey, {MONEY_S} AS s FROM orders))))""")
def b12b(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(MONEY_S).alias("s"))
    o = o.select("o_orderkey", F.expr(RAW_MONEY).alias("bruto"))
    return o.withColumn("valor", CL.clean_float(F.col("bruto")))


RAW_TEXT = "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE '  ' || c_mktsegment || ' ' END"


@query("b12c_clean_text", f"SELECT c_custkey, coalesce(trim({RAW_TEXT}), '') AS valor FROM customer")
def b12c(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", CL.clean_text(F.expr(RAW_TEXT)).alias("valor"))


RAW_BOOL = """CASE o_orderkey % 8 WHEN 0 THEN 'Sim' WHEN 1 THEN ' yes ' WHEN 2 THEN '0' WHEN 3 THEN 'nao' WHEN 4 THEN 'Y'
 WHEN 5 THEN 'talvez' WHEN 6 THEN NULL ELSE 'TRUE' END"""


@query("b12d_clean_bool", f"""SELECT o_orderkey, bruto, coalesce(lower(trim(bruto)) IN ('true','1','sim','s','yes','y'), FALSE) AS valor
FROM (SELECT o_orderkey, {RAW_BOOL} AS bruto FROM orders)""")
def b12d(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(RAW_BOOL).alias("bruto"))
    return o.withColumn("valor", CL.clean_bool(F.col("bruto")))


@query("b13_norm_period", with_views(MOV, MOVQ_SQL) + """SELECT id, periodo,
 CASE WHEN length(periodo) = 6 THEN substr(periodo,1,4) || '-' || substr(periodo,5,2) ELSE periodo END AS competencia FROM movq""")
def b13(spark, sf_dir):
    return movq(spark, sf_dir, ["id", "periodo"]).select("id", "periodo", CL.norm_period(F.col("periodo")).alias("competencia"))


@query("b17_parse_date", """SELECT o_orderkey, texto, CAST(coalesce(try_strptime(texto, '%Y-%m-%d'), try_strptime(texto, '%d/%m/%Y'),
 try_strptime(texto, '%Y%m%d'), try_strptime(texto, '%d-%m-%Y'), try_strptime(texto, '%Y/%m/%d')) AS DATE) AS data
FROM (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
 WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') WHEN 3 THEN strftime(o_orderdate, '%d-%m-%Y') WHEN 4 THEN strftime(o_orderdate, '%Y/%m/%d')
 ELSE 'sem data' END AS texto FROM orders)""")
def b17(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey") % 6, F.col("o_orderdate")
    txt = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "dd/MM/yyyy"))
           .when(k == 2, F.date_format(d, "yyyyMMdd")).when(k == 3, F.date_format(d, "dd-MM-yyyy"))
           .when(k == 4, F.date_format(d, "yyyy/MM/dd")).otherwise(F.lit("sem data")))
    return o.select("o_orderkey", txt.alias("texto")).withColumn("data", CL.parse_date_any(F.col("texto")))


# --- B16, B20, B21 -------------------------------------------------------------------------------------

RAW_TIPO = "CASE id % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN 'Admissão' WHEN 3 THEN 'desligamento' ELSE NULL END"


@query("b16_movements", with_views(MOV) + f"""SELECT id, CAST(cnpj AS STRING) AS cnpj, CAST(cpf AS STRING) AS cpf,
 substr(competencia_mov,1,4) || '-' || substr(competencia_mov,5,2) AS competencia,
 CASE WHEN upper(trim(t)) IN ('1','ADMISSAO','ADMISSÃO','ADMIT','A') THEN 'admissao'
      WHEN upper(trim(t)) IN ('2','DESLIGAMENTO','DEMISSAO','DEMISSÃO','DESLIG','D') THEN 'desligamento'
      WHEN a > 0 THEN 'admissao' WHEN d > 0 THEN 'desligamento' ELSE 'admissao' END AS tipo_movimentacao,
 CAST(NULL AS DATE) AS data_movimentacao
FROM (SELECT id, cnpj, cpf, competencia_mov, {RAW_TIPO} AS t,
  CASE WHEN saldo_movimentacao > 0 THEN 1 ELSE 0 END AS a, CASE WHEN saldo_movimentacao < 0 THEN 1 ELSE 0 END AS d FROM mov)""")
def b16(spark, sf_dir):
    m = mov(spark, sf_dir, ["id", "cnpj", "cpf", "competencia_mov", "saldo_movimentacao"])
    m = m.select("id", "cnpj", "cpf", "competencia_mov", F.expr(RAW_TIPO).alias("tipo"),
                 F.when(F.col("saldo_movimentacao") > 0, 1).otherwise(0).alias("admitidos"),
                 F.when(F.col("saldo_movimentacao") < 0, 1).otherwise(0).alias("desligados"))
    return EN.to_movements(m)


_P = "substr(competencia_mov,1,4) || '-' || substr(competencia_mov,5,2)"


@query("b20_entities", with_views(MOV) + f"""SELECT id, CAST(cnpj AS STRING) AS cnpj, CAST(cpf AS STRING) AS cpf, {_P} AS competencia,
 'movimentacao' AS tipo_entidade, CASE WHEN ({dir_of()}) = 'A' THEN 'admissao' WHEN ({dir_of()}) IS NOT NULL THEN 'desligamento' END AS detalhe,
 CAST(NULL AS DATE) AS data FROM mov WHERE tipo = 'MOV'
UNION ALL SELECT id, CAST(cnpj AS STRING), CAST(cpf AS STRING), {_P}, 'exclusao', tipo_movimentacao, CAST(NULL AS DATE) FROM mov WHERE tipo = 'EXC'
UNION ALL SELECT id, CAST(cnpj AS STRING), CAST(cpf AS STRING), {_P}, 'fora_prazo', {_P},
 CAST(strptime(competencia_dec || '01', '%Y%m%d') AS DATE) FROM mov WHERE tipo = 'FOR'""")
def b20(spark, sf_dir):
    return EN.to_entities(mov(spark, sf_dir, ["id", "cnpj", "cpf", "competencia_mov", "competencia_dec", "tipo",
                                               "tipo_movimentacao"]))


@query("b21_surrogate_id", FLAGSHIP_SQL.replace(
    "SELECT * FROM stock", "SELECT CAST(row_number() OVER (ORDER BY competencia) AS INTEGER) AS id, * FROM stock"))
def b21(spark, sf_dir):
    return EN.with_surrogate_id(flagship(spark, sf_dir), ["competencia"])


@query("b21_fact_ids", with_views(MOV) + """SELECT row_number() OVER (ORDER BY competencia_mov, cnpj, id) AS numero, competencia_mov, cnpj, id
FROM mov""")
def b21f(spark, sf_dir):
    return EN.with_dense_id(mov(spark, sf_dir, ["competencia_mov", "cnpj", "id"]), ["competencia_mov", "cnpj", "id"], out="numero")


# --- A3, A14 ------------------------------------------------------------------------------------------

RAW_NULLS = """CASE c_custkey % 7 WHEN 0 THEN 'NA' WHEN 1 THEN 'N/A' WHEN 2 THEN '' WHEN 3 THEN 'NULL' WHEN 4 THEN '#N/A'
 ELSE c_name END"""


@query("a3_null_literals", f"""SELECT c_custkey, CASE WHEN v IN ('', 'NULL', 'null', 'NA', 'N/A', '#N/A') THEN NULL ELSE v END AS valor,
 CASE WHEN c_mktsegment IN ('', 'NULL', 'null', 'NA', 'N/A', '#N/A') THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM (SELECT c_custkey, {RAW_NULLS} AS v, c_mktsegment FROM customer)""")
def a3(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.expr(RAW_NULLS).alias("valor"), "c_mktsegment")
    return CL.null_literals(c)


@query("a14_apply_schema", with_views(MOV, MOVQ_SQL) + """SELECT id, TRY_CAST(horas_txt AS BIGINT) AS horas_txt,
 TRY_CAST(mes_txt AS INTEGER) AS mes_txt FROM movq""")
def a14(spark, sf_dir):
    q = movq(spark, sf_dir, ["id", "horas_txt", "mes_txt"])
    return CL.apply_schema(q, {"horas_txt": "bigint", "mes_txt": "int", "nao_existe": "int"})


# --- I: scalar-function regression mix -----------------------------------------------------------------

@query("i_scalar_mix", """SELECT o_orderkey, upper(trim(o_orderpriority)) AS prio, CAST(length(o_orderpriority) AS INTEGER) AS len,
 substr(o_orderpriority, 1, 1) AS p1, starts_with(o_orderpriority, '1') AS urgente,
 regexp_matches(o_orderpriority, '^[0-9]-[A-Z]+$') AS simples, regexp_replace(o_orderpriority, '[^A-Z]', '', 'g') AS letras,
 concat(o_orderstatus, '-', CAST(o_custkey AS STRING)) AS chave, split_part(o_orderpriority, '-', 2) AS rotulo,
 translate(o_orderpriority, 'AEIOU', 'aeiou') AS minusc, CAST(o_orderdate AS DATE) + 30 AS d30,
 CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS d1m, strftime(o_orderdate, '%Y%m') AS ym,
 round(abs(o_totalprice - 100000.0), 2) AS dist, coalesce(nullif(o_orderstatus, 'P'), 'pendente') AS status,
 TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS nivel, md5(o_orderpriority) AS h_md5,
 sha256(o_orderpriority) AS h_sha FROM orders""")
def i_mix(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    p = F.col("o_orderpriority")
    d = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey", F.upper(F.trim(p)).alias("prio"), F.length(p).alias("len"), F.substring(p, 1, 1).alias("p1"),
        p.startswith("1").alias("urgente"), p.rlike("^[0-9]-[A-Z]+$").alias("simples"),
        F.regexp_replace(p, "[^A-Z]", "").alias("letras"),
        F.concat(F.col("o_orderstatus"), F.lit("-"), F.col("o_custkey").cast("string")).alias("chave"),
        F.get(F.split(p, "-"), 1).alias("rotulo"), F.translate(p, "AEIOU", "aeiou").alias("minusc"),
        F.date_add(d, 30).alias("d30"), F.add_months(d, 1).alias("d1m"), F.date_format(d, "yyyyMM").alias("ym"),
        F.round(F.abs(F.col("o_totalprice") - 100000.0), 2).alias("dist"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")), F.lit("pendente")).alias("status"),
        F.substring(p, 1, 1).try_cast("int").alias("nivel"), F.md5(p).alias("h_md5"), F.sha2(p, 256).alias("h_sha"))


@query("b20_balance_entities", with_views(MOV) + f"""SELECT CAST(cnpj AS STRING) AS cnpj, {_P} AS competencia,
 CAST(count_if(coalesce(tipo <> 'EXC' AND ({dir_of()}) = 'A', FALSE)) AS BIGINT) AS admissoes, CAST(count_if(coalesce(tipo <> 'EXC' AND ({dir_of()}) = 'D', FALSE)) AS BIGINT) AS desligamentos,
 CAST(count_if(coalesce(tipo = 'EXC' AND ({dir_of()}) = 'A', FALSE)) AS BIGINT) AS exc_admissoes, CAST(count_if(coalesce(tipo = 'EXC' AND ({dir_of()}) = 'D', FALSE)) AS BIGINT) AS exc_desligamentos,
 CAST(count_if(coalesce(tipo <> 'EXC' AND ({dir_of()}) = 'A', FALSE)) AS BIGINT) - CAST(count_if(coalesce(tipo <> 'EXC' AND ({dir_of()}) = 'D', FALSE)) AS BIGINT)
  - CAST(count_if(coalesce(tipo = 'EXC' AND ({dir_of()}) = 'A', FALSE)) AS BIGINT) + CAST(count_if(coalesce(tipo = 'EXC' AND ({dir_of()}) = 'D', FALSE)) AS BIGINT) AS saldo
FROM mov WHERE length(trim(CAST(cnpj AS STRING))) > 0 GROUP BY cnpj, competencia_mov""")
def b20b(spark, sf_dir):
    return EN.balance_entities(mov(spark, sf_dir, ["cnpj", "competencia_mov", "tipo", "tipo_movimentacao"]))
