"""Sources and sinks (family A, E11): round trips through the shared scratch folder, text parsers
and the file catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from jobflow.operators import balance as B
from jobflow.operators import filters as C
from jobflow.operators import quality as Q
from jobflow.plans.filter_queries import cnae_table
from jobflow.plans.jobs import balance_from_layout
from jobflow.session import scratch_path, session_conf
from jobflow.sources import catalog as CT
from jobflow.sources import files as FL
from jobflow.sources import text as TX
from jobflow.plans.balance_queries import BAL_COLS, FLAGSHIP_SQL
from jobflow.plans.registry import query
from jobflow.plans.sql import CATALOG, ESTAB, MOV, with_views
from jobflow.sources.tables import catalog, estab, mov, table

RT_COLS = ["id", "competencia_mov", "tipo", "tipo_movimentacao", "saldo_movimentacao", "cnpj", "salario"]
RT_SCHEMA = ("id bigint, competencia_mov string, tipo string, tipo_movimentacao string, saldo_movimentacao int, "
             "cnpj bigint, salario double")
_LAYOUTS: dict = {}


# lineitem rows of about 14 stored bytes travel to the join as about 80; a join's task sorts a part of them
_PART_BYTES = 8 << 20


def moves(spark, sf_dir, cols):
    """mov with ``cols`` from one join per session, stored for the inputs that are built from several selections of it.

    The join has as many partitions as the table's size asks for, so a task's sort does not grow with the table.  It is a shuffle
    at any size, so what it costs grows with the table and not by a leap where orders can no longer be broadcast.
    """
    key = ("moves", spark.sparkContext.applicationId, sf_dir, *cols)
    if key not in _LAYOUTS:
        p, at = scratch_path(spark, "moves"), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/lineitem.parquet")
        size = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // _PART_BYTES))
        with session_conf(spark, spark__sql__shuffle__partitions=str(parts)):
            df = mov(spark, sf_dir, list(cols), shuffled=True)
            df.write.option("compression", "zstd").parquet(p)
        _LAYOUTS[key] = spark.read.schema(df.schema).parquet(p)
    return _LAYOUTS[key]


def _unsorted(spark):
    """Files of a few partition values are written side by side: a task holds one open file for each instead of sorting its rows."""
    return session_conf(spark, spark__sql__maxConcurrentOutputFileWriters="32")


def _csv_dir(spark, sf_dir):
    """mov projection written once per session as ';' CSV with header (A1 / A16 input)."""
    key = ("csv", spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYOUTS:
        p = scratch_path(spark, "csv")
        mov(spark, sf_dir, RT_COLS).write.option("header", True).option("sep", ";").csv(p)
        _LAYOUTS[key] = p
    return _LAYOUTS[key]


def _layout(spark, sf_dir):
    """mov written once per session in the tipo/ano/mes Parquet layout (A7-A13 input)."""
    key = ("parquet", spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYOUTS:
        p = scratch_path(spark, "layout")
        FL.write_monthly(mov(spark, sf_dir, RT_COLS), p)
        _LAYOUTS[key] = p
    return _LAYOUTS[key]


RT_SQL = with_views(MOV) + "SELECT " + ", ".join(RT_COLS) + " FROM mov"


@query("a1_read_delimited", RT_SQL)
def a1(spark, sf_dir):
    return TX.read_delimited(spark, _csv_dir(spark, sf_dir), sep=";", schema=RT_SCHEMA)


_LINE = "CAST(id AS STRING) || ';' || competencia_mov || ';' || CAST(saldo_movimentacao AS STRING)"


@query("a16_file_profile", with_views(MOV) + f"""SELECT CAST(id % 4 AS INTEGER) AS parte, CAST(sum(length({_LINE}) + 1) + length('linha') + 1 AS BIGINT) AS bytes,
 count(*) + 1 AS linhas, count(*) AS linhas_estimadas FROM mov GROUP BY 1""")
def a16(spark, sf_dir):
    path = scratch_path(spark, "profile")
    m = mov(spark, sf_dir, RT_COLS).select(F.expr(_LINE).alias("linha"), (F.col("id") % 4).cast("int").alias("parte"))
    # one file per part: its rows in one task
    with _unsorted(spark):
        m.repartition(4, "parte").write.partitionBy("parte").option("header", True).csv(path)
    prof = TX.file_profile(spark, path + "/*/*.csv")
    return prof.select(F.regexp_extract("arquivo", r"parte=(\d+)", 1).cast("int").alias("parte"), "bytes", "linhas", "linhas_estimadas")


JUNK_SQL = """SELECT '' AS value FROM customer UNION ALL SELECT '# ' || c_name FROM customer
 UNION ALL SELECT 'comentario, cliente ' || CAST(c_custkey AS STRING) FROM customer
 UNION ALL SELECT 'lixo sem separador ' || CAST(c_custkey AS STRING) FROM customer"""
SALVAGE_COLS = ["id", "competencia_mov", "tipo", "tipo_movimentacao", "saldo_movimentacao", "cnpj"]


@query("a4_salvage_lines", with_views(MOV) + "SELECT " + ", ".join(f"CAST({c} AS STRING) AS {c}" for c in SALVAGE_COLS) +
       " FROM mov UNION ALL SELECT 'comentario, cliente ' || CAST(c_custkey AS STRING), " +
       ", ".join(["NULL"] * (len(SALVAGE_COLS) - 1)) + " FROM customer")
def a4(spark, sf_dir):
    p = scratch_path(spark, "salvage")
    mov(spark, sf_dir, SALVAGE_COLS).write.option("header", True).option("sep", ";").csv(p + "/dados")
    c = table(spark, sf_dir, "customer")
    junk = (c.select(F.lit("").alias("value"))
            .unionByName(c.select(F.concat(F.lit("# "), "c_name").alias("value")))
            .unionByName(c.select(F.concat(F.lit("comentario, cliente "), F.col("c_custkey").cast("string")).alias("value")))
            .unionByName(c.select(F.concat(F.lit("lixo sem separador "), F.col("c_custkey").cast("string")).alias("value"))))
    junk.write.text(p + "/lixo")
    return TX.salvage_lines(spark, p + "/*", ";".join(SALVAGE_COLS))


POS_LINES = """SELECT cnpj || ';' || CAST(uf AS STRING) || ';' || CAST(CAST(cnpj AS BIGINT) % 97 AS STRING) || ';' || secao || ';' ||
   CASE WHEN admitidos = 0 THEN 'x' ELSE CAST(admitidos AS STRING) END || ';' || CAST(desligados AS STRING) AS value FROM estab
 UNION ALL SELECT '#comentario ' || CAST(c_custkey AS STRING) FROM customer
 UNION ALL SELECT CAST(c_custkey AS STRING) || ';' || c_name FROM customer
 UNION ALL SELECT '' FROM customer"""


def _pos_lines(spark, sf_dir):
    e = estab(spark, sf_dir, ["cnpj", "uf", "secao", "admitidos", "desligados"])
    c = table(spark, sf_dir, "customer")
    a_txt = F.when(F.col("admitidos") == 0, F.lit("x")).otherwise(F.col("admitidos").cast("string"))
    data = e.select(F.concat_ws(";", "cnpj", F.col("uf").cast("string"), (F.col("cnpj").cast("bigint") % 97).cast("string"),
                                "secao", a_txt, F.col("desligados").cast("string")).alias("value"))
    return (data.unionByName(c.select(F.concat(F.lit("#comentario "), F.col("c_custkey").cast("string")).alias("value")))
            .unionByName(c.select(F.concat(F.col("c_custkey").cast("string"), F.lit(";"), "c_name").alias("value")))
            .unionByName(c.select(F.lit("").alias("value"))))


@query("a5_positional", with_views(MOV, ESTAB) + f""", l AS ({POS_LINES})
SELECT trim(split_part(v, ';', 1)) AS cnpj, trim(split_part(v, ';', 2)) AS uf, trim(split_part(v, ';', 3)) AS municipio,
 trim(split_part(v, ';', 4)) AS estabelecimento,
 CASE WHEN regexp_matches(trim(split_part(v, ';', 5)), '^[0-9]+$') THEN CAST(trim(split_part(v, ';', 5)) AS BIGINT) ELSE 0 END AS admissoes,
 CASE WHEN regexp_matches(trim(split_part(v, ';', 6)), '^[0-9]+$') THEN CAST(trim(split_part(v, ';', 6)) AS BIGINT) ELSE 0 END AS desligamentos,
 CASE WHEN regexp_matches(trim(split_part(v, ';', 5)), '^[0-9]+$') AND regexp_matches(trim(split_part(v, ';', 6)), '^[0-9]+$')
  THEN CAST(trim(split_part(v, ';', 5)) AS BIGINT) - CAST(trim(split_part(v, ';', 6)) AS BIGINT) ELSE 0 END AS saldo
FROM (SELECT trim(value) AS v FROM l) WHERE length(v) > 0 AND NOT starts_with(v, '#') AND len(string_split(v, ';')) >= 6""")
def a5(spark, sf_dir):
    return TX.parse_positional(_pos_lines(spark, sf_dir))


def _keyed_files(spark, sf_dir):
    """Keyed CSV: names with a separator between quotes, lines with a field too many (every fifth) or too few (every seventh)."""
    key = ("keyed", spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYOUTS:
        root, k = scratch_path(spark, "keyed"), F.col("c_custkey")
        name = F.concat(F.lit('"'), F.replace("c_name", F.lit("#"), F.lit(';""')), F.lit('"'))
        whole = F.concat_ws(";", k.cast("string"), F.lit("SP"), name, (k % 9).cast("string"))
        line = F.when(k % 5 == 0, F.concat(whole, F.lit(";9;9"))).when(k % 7 == 0, F.concat_ws(";", k.cast("string"), F.lit("SP"))).otherwise(whole)
        c = table(spark, sf_dir, "customer").select(F.lit(1).alias("n"), line.alias("value"))
        head = spark.range(1).select(F.lit(0).alias("n"), F.lit("CNPJ;UF;Município;admissoes").alias("value"))
        head.unionByName(c).coalesce(1).sortWithinPartitions("n").select("value").write.text(root)
        _LAYOUTS[key] = root
    return _LAYOUTS[key]


@query("a6_read_keyed", """SELECT CAST(c_custkey AS STRING) AS cnpj, 'SP' AS uf, CASE WHEN c_custkey % 7 <> 0 THEN replace(c_name, '#', ';"') END AS municipio,
 CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE c_custkey % 9 END AS admissoes FROM customer WHERE c_custkey % 5 <> 0""")
def a6f(spark, sf_dir):
    return TX.read_keyed(spark, _keyed_files(spark, sf_dir))


@query("a6_bad_lines", "SELECT count(*) AS linhas, CAST(count_if(c_custkey % 5 = 0) AS BIGINT) AS ruins FROM customer")
def a6b(spark, sf_dir):
    return TX.bad_lines(spark, _keyed_files(spark, sf_dir)).select("linhas", "ruins")


@query("a4_quoted", """SELECT CAST(c_custkey AS STRING) AS "CNPJ", 'SP' AS "UF", CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 <> 0 THEN replace(c_name, '#', ';"') END
 AS "Município", CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 <> 0 THEN CAST(c_custkey % 9 AS STRING) END AS admissoes FROM customer""")
def a4q(spark, sf_dir):
    return TX.salvage_lines(spark, _keyed_files(spark, sf_dir))


KEYED_SRC = """SELECT cnpj AS CNPJ, CAST(uf AS STRING) AS UF, secao AS "Município",
  CASE WHEN admitidos % 4 = 0 THEN CAST(admitidos AS STRING) || ',5' ELSE CAST(admitidos AS STRING) END AS admissoes,
  CASE WHEN desligados = 0 THEN 'n/d' ELSE CAST(desligados AS STRING) || '.0' END AS desligamentos,
  CAST(saldo AS STRING) AS saldo FROM estab"""


def _lenient(c):
    return f"CASE WHEN TRY_CAST(replace(trim({c}), ',', '.') AS DOUBLE) IS NULL THEN 0 ELSE CAST(trunc(TRY_CAST(replace(trim({c}), ',', '.') AS DOUBLE)) AS BIGINT) END"


@query("a6_keyed", with_views(MOV, ESTAB) + f""", k AS ({KEYED_SRC})
SELECT trim(CNPJ) AS cnpj, trim(UF) AS uf, trim("Município") AS municipio, {_lenient('admissoes')} AS admissoes,
 {_lenient('desligamentos')} AS desligamentos, {_lenient('saldo')} AS saldo FROM k""")
def a6(spark, sf_dir):
    e = estab(spark, sf_dir)
    src = e.select(F.col("cnpj").alias("CNPJ"), F.col("uf").cast("string").alias("UF"), F.col("secao").alias("Município"),
                   F.when(F.col("admitidos") % 4 == 0, F.concat(F.col("admitidos").cast("string"), F.lit(",5")))
                   .otherwise(F.col("admitidos").cast("string")).alias("admissoes"),
                   F.when(F.col("desligados") == 0, F.lit("n/d"))
                   .otherwise(F.concat(F.col("desligados").cast("string"), F.lit(".0"))).alias("desligamentos"),
                   F.col("saldo").cast("string").alias("saldo"))
    return TX.parse_keyed(src)


# --- Parquet layout round trips ----------------------------------------------------------------------

_PCOLS = ", ".join(RT_COLS)
_PART_SQL = "CAST(substr(competencia_mov,1,4) AS INTEGER) AS ano, CAST(substr(competencia_mov,5,2) AS INTEGER) AS mes"


@query("a7_period_scan", with_views(MOV) + f"SELECT {_PCOLS}, {_PART_SQL} FROM mov "
       "WHERE tipo = 'MOV' AND competencia_mov IN ('202103', '202211')")
def a7(spark, sf_dir):
    df = FL.read_period(spark, _layout(spark, sf_dir), [(2021, 3), (2022, 11)], "MOV")
    return df.select(*RT_COLS, "ano", "mes")


@query("a8_write_monthly", with_views(MOV) + f"SELECT tipo, {_PART_SQL}, count(*) AS linhas FROM mov GROUP BY ALL")
def a8(spark, sf_dir):
    df = spark.read.parquet(_layout(spark, sf_dir))
    return df.groupBy("tipo", "ano", "mes").agg(F.count(F.lit(1)).alias("linhas"))


@query("a9_consolidate_month", with_views(MOV) + f"SELECT {_PCOLS} FROM mov WHERE competencia_mov = '202103'")
def a9(spark, sf_dir):
    root = _layout(spark, sf_dir)
    parts = [FL.read_period(spark, root, [(2021, 3)], t).drop("ano", "mes") for t in ("MOV", "EXC", "FOR")]
    return FL.consolidate_month(parts).select(*RT_COLS)


@query("a10_consolidate_year", with_views(MOV) + f"SELECT {_PCOLS}, {_PART_SQL} FROM mov WHERE competencia_mov LIKE '2021%'")
def a10(spark, sf_dir):
    out = FL.consolidate(spark, _layout(spark, sf_dir), [2021], scratch_path(spark, "anual"))
    return spark.read.parquet(out).select(*RT_COLS, "ano", "mes")


@query("a11_consolidate_range", with_views(MOV) + f"SELECT {_PCOLS}, {_PART_SQL} FROM mov "
       "WHERE competencia_mov LIKE '2021%' OR competencia_mov LIKE '2022%'")
def a11(spark, sf_dir):
    out = FL.consolidate(spark, _layout(spark, sf_dir), [2021, 2022], scratch_path(spark, "faixa"))
    return spark.read.parquet(out).select(*RT_COLS, "ano", "mes")


@query("a13_per_file_counts", with_views(MOV) + f"SELECT tipo, {_PART_SQL}, count(*) AS linhas FROM mov GROUP BY ALL")
def a13(spark, sf_dir):
    pf = FL.per_file_counts(spark, _layout(spark, sf_dir) + "/*/*/*")
    p = F.col("arquivo")
    pf = pf.where("motivo IS NULL")
    return (pf.select(F.regexp_extract(p, r"tipo=([A-Z]+)", 1).alias("tipo"),
                      F.regexp_extract(p, r"ano=(\d+)", 1).cast("int").alias("ano"),
                      F.regexp_extract(p, r"mes=(\d+)", 1).cast("int").alias("mes"), "linhas")
            .groupBy("tipo", "ano", "mes").agg(F.sum("linhas").alias("linhas")))


# --- months whose columns and types differ ---------------------------------------------------------------

DRIFT_COLS = [*RT_COLS, "horas_contratuais"]


def _drift(spark, sf_dir):
    """The layout in three generations: no salary until 2018; salary in whole cents until 2020; then with two decimals, with contract
    hours, the company as text and a wider balance."""
    key = ("drift", spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYOUTS:
        root, m, y = scratch_path(spark, "drift"), moves(spark, sf_dir, DRIFT_COLS), F.substring("competencia_mov", 1, 4)
        FL.write_monthly(m.where(y <= "2018").drop("salario", "horas_contratuais"), root)
        FL.write_monthly(m.where((y > "2018") & (y <= "2020")).drop("horas_contratuais").withColumn(
            "salario", F.round(F.col("salario") * 100).cast("bigint")), root)
        FL.write_monthly(m.where(y > "2020").withColumns({
            "cnpj": F.col("cnpj").cast("string"), "saldo_movimentacao": F.col("saldo_movimentacao").cast("bigint")}), root)
        _LAYOUTS[key] = root
    return _LAYOUTS[key]


def _drift_sql(years: str) -> str:
    y = "substr(competencia_mov, 1, 4)"
    return (with_views(MOV) + f"""SELECT id, competencia_mov, tipo, tipo_movimentacao, CAST(saldo_movimentacao AS BIGINT) AS saldo_movimentacao,
 CAST(cnpj AS STRING) AS cnpj, CASE WHEN {y} > '2020' THEN salario WHEN {y} > '2018' THEN CAST(round(salario * 100) AS DOUBLE) END AS salario,
 CASE WHEN {y} > '2020' THEN horas_contratuais END AS horas_contratuais, {_PART_SQL} FROM mov WHERE {y} IN ({years})""")


_ALL_YEARS = ", ".join(f"'{y}'" for y in range(2010, 2040))


@query("a7_schema_drift", _drift_sql(_ALL_YEARS))
def a7d(spark, sf_dir):
    return FL.read_period(spark, _drift(spark, sf_dir)).select(*DRIFT_COLS, "ano", "mes")


@query("a7_drift_months", with_views(MOV) + f"SELECT {', '.join(c for c in RT_COLS if c != 'salario')}, {_PART_SQL}, "
       "CAST(round(salario * 100) AS BIGINT) AS salario FROM mov WHERE tipo IN ('MOV', 'EXC') AND competencia_mov IN ('201904', '202011')")
def a7m(spark, sf_dir):
    return FL.read_period(spark, _drift(spark, sf_dir), [(2019, 4), (2020, 11)], ["MOV", "EXC"]).select(*RT_COLS, "ano", "mes")


@query("a10_schema_drift", _drift_sql("'2018', '2019', '2021'"))
def a10d(spark, sf_dir):
    out = FL.consolidate(spark, _drift(spark, sf_dir), [2018, 2019, 2021], scratch_path(spark, "drift-faixa"))
    return spark.read.parquet(out).select(*DRIFT_COLS, "ano", "mes")


@query("n2_schema_drift", FLAGSHIP_SQL)
def n2d(spark, sf_dir):
    return balance_from_layout(spark, _drift(spark, sf_dir))


@query("a15_preview", with_views(MOV) + f"SELECT {_PCOLS} FROM mov ORDER BY {_PCOLS} LIMIT 5")
def a15(spark, sf_dir):
    return FL.preview(mov(spark, sf_dir, RT_COLS), 5)


# --- catalogue --------------------------------------------------------------------------------------------

META_SQL = r"""meta AS (SELECT *, CASE WHEN regexp_extract(file_name, '(MOV|EXC|FOR)(\d{4})(\d{2})', 1) <> ''
   THEN regexp_extract(file_name, '(MOV|EXC|FOR)(\d{4})(\d{2})', 1) ELSE 'outros' END AS tipo,
 CAST(NULLIF(regexp_extract(file_name, '(MOV|EXC|FOR)(\d{4})(\d{2})', 2), '') AS INTEGER) AS ano,
 CAST(NULLIF(regexp_extract(file_name, '(MOV|EXC|FOR)(\d{4})(\d{2})', 3), '') AS INTEGER) AS mes,
 NULLIF(regexp_extract(file_name, '(MOV|EXC|FOR)(\d{4})(\d{2})', 2) || regexp_extract(file_name, '(MOV|EXC|FOR)(\d{4})(\d{2})', 3), '') AS competencia,
 lower(regexp_extract(file_name, '\.([A-Za-z0-9]+)$', 1)) AS extensao,
 CASE WHEN lower(regexp_extract(file_name, '\.([A-Za-z0-9]+)$', 1)) IN ('7z','zip') THEN 'compactado'
      WHEN lower(regexp_extract(file_name, '\.([A-Za-z0-9]+)$', 1)) IN ('txt','csv') THEN 'texto'
      WHEN lower(regexp_extract(file_name, '\.([A-Za-z0-9]+)$', 1)) = 'parquet' THEN 'parquet' ELSE 'outro' END AS modalidade
 FROM catalog)"""
CV = with_views(CATALOG, META_SQL)


def _meta(spark, sf_dir):
    return CT.with_file_meta(catalog(spark, sf_dir))


@query("a19_file_meta", CV + "SELECT file_name, tipo, ano, mes, competencia, extensao, modalidade FROM meta")
def a19(spark, sf_dir):
    return _meta(spark, sf_dir).select("file_name", "tipo", "ano", "mes", "competencia", "extensao", "modalidade")


@query("a20_catalog_filter", CV + "SELECT file_name, ano, uf, tipo FROM meta WHERE ano BETWEEN 2021 AND 2023 "
       "AND uf IN (1, 2, 3) AND tipo IN ('MOV', 'FOR')")
def a20(spark, sf_dir):
    c = CT.filter_catalog(_meta(spark, sf_dir), years=(2021, 2023), ufs=[1, 2, 3], tipos=["MOV", "FOR"])
    return c.select("file_name", "ano", "uf", "tipo")


def _report_sql():
    dims = ["extensao", "tipo", "competencia", "uf", "ano"]
    agg = ("count(*) AS arquivos, CAST(sum(size_bytes) AS BIGINT) AS bytes_total, round(avg(size_bytes), 6) AS bytes_medio, "
           "min(size_bytes) AS bytes_min, max(size_bytes) AS bytes_max, CAST(count_if(processed) AS BIGINT) AS processados")
    parts = [f"SELECT '{d}' AS dimensao, CAST({d} AS STRING) AS valor, {agg} FROM meta GROUP BY CAST({d} AS STRING)" for d in dims]
    parts.append(f"SELECT 'total' AS dimensao, '*' AS valor, {agg} FROM meta")
    return CV + " UNION ALL ".join(parts)


@query("a21_catalog_report", _report_sql())
def a21(spark, sf_dir):
    return CT.catalog_report(_meta(spark, sf_dir))


@query("a21_catalog_distinct", CV + "SELECT count(DISTINCT ano) AS anos, count(DISTINCT uf) AS ufs, count(DISTINCT tipo) AS tipos, "
       "count(DISTINCT competencia) AS competencias FROM meta")
def a21d(spark, sf_dir):
    return CT.catalog_distincts(_meta(spark, sf_dir))


@query("e11_success_by_month", CV + "SELECT mes, round(avg(CASE WHEN processed THEN 100.0 ELSE 0.0 END), 6) AS taxa_sucesso, "
       "count(*) AS arquivos FROM meta GROUP BY mes")
def e11(spark, sf_dir):
    return CT.success_rate_by_month(_meta(spark, sf_dir))


# --- separator profiling --------------------------------------------------------------------------------

def _doc_lines(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("arquivo"), F.explode(F.split("text", "\n", -1)).alias("value"))


@query("a22_delimiter_profile", f"""WITH l AS (SELECT doc_id AS arquivo, unnest(string_split(text, chr(10))) AS l FROM documents),
x0 AS (SELECT arquivo, l, unnest([{{'ordem': 0, 'separador': ';'}}, {{'ordem': 1, 'separador': ','}},
  {{'ordem': 2, 'separador': chr(9)}}, {{'ordem': 3, 'separador': '|'}}, {{'ordem': 4, 'separador': ':'}},
  {{'ordem': 5, 'separador': '#'}}]) AS c FROM l),
x AS (SELECT arquivo, c.ordem AS ordem, c.separador AS separador, CAST(length(l) - length(replace(l, c.separador, '')) AS INTEGER) AS n FROM x0),
pc AS (SELECT arquivo, ordem, separador, n, count(*) AS k FROM x GROUP BY ALL),
st AS (SELECT arquivo, ordem, separador, CAST(sum(k) AS BIGINT) AS linhas, min(n) AS minimo, max(n) AS maximo,
  sum(n * k) / sum(k) AS media, sqrt(greatest(sum(n * n * k) / sum(k) - pow(sum(n * k) / sum(k), 2), 0.0)) AS desvio,
  arg_max(n, k * 1000000 - n) AS modal_n, max(k) AS modal_k FROM pc GROUP BY ALL),
sc AS (SELECT arquivo, ordem, separador, linhas, minimo, maximo, round(media, 6) AS media, round(desvio, 6) AS desvio,
  round(CASE WHEN maximo = 0 THEN 0.0 ELSE greatest(media - 0.3 * (maximo - minimo) - 0.2 * desvio +
   CASE WHEN maximo - minimo <= 1 AND media > 2 THEN 0.5 * media ELSE 0.0 END, 0.0) END, 6) AS score,
  modal_n + 1 AS colunas_modal, round(modal_k / linhas, 6) AS consistencia FROM st),
r AS (SELECT *, consistencia >= 0.8 AND colunas_modal > 2 AS estrutural,
  consistencia >= 0.7 AND maximo + 1 >= 2 AS valido FROM sc),
rk AS (SELECT *, row_number() OVER (PARTITION BY arquivo ORDER BY CASE WHEN estrutural THEN 0 WHEN valido AND score > 0 THEN 1 ELSE 2 END,
  CASE WHEN estrutural THEN ordem END NULLS LAST, score DESC, ordem) AS rn FROM r)
SELECT arquivo, ordem, separador, linhas, minimo, maximo, media, desvio, score, colunas_modal, consistencia,
 (rn = 1 AND (estrutural OR (valido AND score > 0))) AS escolhido FROM rk""")
def a22(spark, sf_dir):
    return TX.delimiter_profile(_doc_lines(spark, sf_dir))


@query("a23_header_delimiter", """SELECT doc_id, CASE WHEN b = 0 THEN NULL WHEN c1 = b THEN ';' WHEN c2 = b THEN ',' WHEN c3 = b THEN chr(9)
 ELSE '|' END AS separador FROM (SELECT doc_id, c1, c2, c3, c4, greatest(c1, c2, c3, c4) AS b FROM (
 SELECT doc_id, length(h) - length(replace(h, ';', '')) AS c1, length(h) - length(replace(h, ',', '')) AS c2,
  length(h) - length(replace(h, chr(9), '')) AS c3, length(h) - length(replace(h, '|', '')) AS c4
 FROM (SELECT doc_id, split_part(text, chr(10), 1) AS h FROM documents)))""")
def a23(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.get(F.split("text", "\n", -1), 0).alias("value"))
    return d.select("doc_id", TX.delimiter_of_header(d).alias("separador"))


_GROUPS_SQL = " + ".join(
    "CAST(" + " OR ".join(f"contains(nomes, '{v}')" for v in vs) + " AS INTEGER)" for vs in Q.ESSENTIAL_GROUPS.values())


def _accept_sql(cols: list[str], rows: str) -> str:
    """Acceptance computed from the column names and the row count of ``rows``."""
    return (f"SELECT linhas_min, colunas, grupos, linhas_min >= 2 AND colunas >= 3 AND grupos >= 2 AS aceito FROM (SELECT linhas_min, "
            f"len(string_split(nomes, ' ')) AS colunas, {_GROUPS_SQL} AS grupos FROM (SELECT upper('{' '.join(cols)}') AS nomes, "
            f"(SELECT least(count(*), 2) FROM {rows}) AS linhas_min))")


# a table of the layout, one with too few known fields, one with too few columns, one that is only a header
RECOVERED = {"aceita": ["competencia_mov", "municipio", "saldo_movimentacao"], "sem_campos": ["cnpj", "secao", "idade", "municipio"],
             "estreita": ["competencia_mov", "municipio"], "so_cabecalho": ["competencia_mov", "municipio", "cnpj"]}


@query("a24_accept_recovered", with_views(MOV) + " UNION ALL ".join(
    f"SELECT '{name}' AS caso, * FROM ({_accept_sql(cols, 'mov' if name != 'so_cabecalho' else 'mov WHERE id < 0')})"
    for name, cols in RECOVERED.items()))
def a24(spark, sf_dir):
    parts = []
    for name, cols in RECOVERED.items():
        m = mov(spark, sf_dir, ["id", *cols])
        m = m.where("id < 0") if name == "so_cabecalho" else m
        got = TX.accept_recovered(m.select(*cols), Q.ESSENTIAL_GROUPS)
        parts.append(got.select(F.lit(name).alias("caso"), F.col("linhas_min").cast("bigint").alias("linhas_min"),
                                F.col("colunas").cast("bigint").alias("colunas"), "grupos", "aceito"))
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- landed files: A13 conversion, A17, A22, A23 ----------------------------------------------------------

def _landed(spark, sf_dir):
    """Files of three layouts written once per session: ';' text, ',' text with its columns in another order, and ISO-8859-1
    text with accented names, each with malformed lines, plus a compressed file that cannot be read and an empty one."""
    key = ("landed", spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYOUTS:
        root = scratch_path(spark, "landed")
        m = moves(spark, sf_dir, RT_COLS)
        third = F.pmod("id", F.lit(3))
        m.where(third == 0).write.option("header", True).option("sep", ";").csv(f"{root}/a")
        m.where(third == 1).select(*reversed(RT_COLS)).write.option("header", True).option("sep", ",").csv(f"{root}/b")
        accents = {"competencia_mov": "competênciamov", "tipo_movimentacao": "tipomovimentação", "salario": "salário"}
        m.where(third == 2).select(*[F.col(c).alias(accents.get(c, c)) for c in RT_COLS]).write.option("header", True).option(
            "sep", ";").option("encoding", "ISO-8859-1").csv(f"{root}/c")
        c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("k"))
        head = ";".join(RT_COLS)  # whole lines are the one column, and its name is the header of each file
        few = c.select(F.concat("k", F.lit(";202101")).alias(head))
        bad = c.where("k % 4 = 0").select(F.concat("k", F.lit(";2021;MOV;10;1;1;1.0")).alias(head))
        few.unionByName(bad).write.option("header", True).option("sep", "\t").csv(f"{root}/d")
        broken = f"{root}/e"
        spark.range(1).coalesce(1).select(F.lit("isto nao e gzip").alias("value")).write.text(broken)
        fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(broken).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for f in fs.listStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(broken)):
            if f.getPath().getName().endswith(".txt"):
                fs.rename(f.getPath(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{broken}/quebrado.txt.gz"))
        _LAYOUTS[key] = root
    return _LAYOUTS[key]


_LANDED = "/{a,b,c,d,e}/*.{csv,txt,gz}"


def _damaged(spark, sf_dir):
    """Per region: a whole gzip file of its movements, the first half of it, text named as gzip, a file of an unknown separator,
    one that is only a header, and an empty one."""
    key = ("damaged", spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYOUTS:
        root = scratch_path(spark, "damaged")
        m = moves(spark, sf_dir, [*RT_COLS, "regiao"]).withColumnRenamed("regiao", "r").repartition("r")
        with _unsorted(spark):
            for name, sep, codec in (("inteiros", ";", "gzip"), ("dois_pontos", ":", "none")):
                m.write.partitionBy("r").option("header", True).option("sep", sep).option("compression", codec).csv(f"{root}/{name}")
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        line = ";".join(RT_COLS).encode()
        for f in fs.globStatus(path(f"{root}/inteiros/*/*.gz")):
            r = f.getPath().getParent().getName()
            half = jvm.org.apache.commons.io.input.BoundedInputStream(fs.open(f.getPath()), f.getLen() // 2)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(half, fs.create(path(f"{root}/cortados/{r}.csv.gz")), 1 << 16, True)
            for name, data in ((f"texto/{r}.csv.gz", line + b"\n" + line), (f"titulo/{r}.csv", line), (f"vazios/{r}.csv", b"")):
                out = fs.create(path(f"{root}/{name}"))
                out.write(data)
                out.close()
        _LAYOUTS[key] = root
    return _LAYOUTS[key]


_DAMAGED = "/{inteiros/*,cortados,texto,dois_pontos/*,titulo,vazios}/*.{csv,gz}"
DAMAGED_SQL = """(SELECT regiao FROM mov GROUP BY regiao) g, (VALUES ('truncado'), ('ilegivel'), ('separador_desconhecido'), ('vazio'){}) v(motivo)"""


@query("a13_rejects", with_views(MOV) + "SELECT motivo, count(*) AS arquivos, CAST(0 AS BIGINT) AS linhas, CAST(0 AS BIGINT) AS ruins FROM "
       + DAMAGED_SQL.format(", ('so_cabecalho')") + " GROUP BY motivo UNION ALL SELECT NULL, count(DISTINCT regiao), count(*), 0 FROM mov")
def a13r(spark, sf_dir):
    status = FL.convert_many(spark, _damaged(spark, sf_dir) + _DAMAGED, scratch_path(spark, "convert"))
    return status.groupBy("motivo").agg(F.count("*").alias("arquivos"), F.sum("linhas").alias("linhas"), F.sum("ruins").alias("ruins"))


@query("a13_convert", with_views(MOV) + "SELECT 'convertidas' AS medida, (SELECT count(*) FROM mov) + "
       "(SELECT count(*) FROM customer WHERE c_custkey % 4 = 0) AS n UNION ALL "
       "SELECT 'quarentena', count(*) FROM customer UNION ALL SELECT 'ilegiveis', 1")
def a13c(spark, sf_dir):
    out = scratch_path(spark, "convert")
    status = FL.convert_many(spark, _landed(spark, sf_dir) + _LANDED, out)
    n = F.count(F.lit(1)).alias("n")
    return (spark.read.parquet(out).agg(n).select(F.lit("convertidas").alias("medida"), "n")
            .unionByName(spark.read.parquet(out + "_quarentena").agg(n).select(F.lit("quarentena").alias("medida"), "n"))
            .unionByName(status.where("motivo IS NOT NULL AND arquivo LIKE '%.gz'").agg(n).select(F.lit("ilegiveis").alias("medida"), "n")))


@query("a23_landed_headers", """SELECT * FROM (VALUES (';', 'UTF-8', 'id;competencia_mov;tipo;tipo_movimentacao;saldo_movimentacao;cnpj;salario'),
 (',', 'UTF-8', 'salario,cnpj,saldo_movimentacao,tipo_movimentacao,tipo,competencia_mov,id'),
 (';', 'ISO-8859-1', 'id;competênciamov;tipo;tipomovimentação;saldo_movimentacao;cnpj;salário')) t(separador, codificacao, cabecalho)""")
def a23l(spark, sf_dir):
    heads = TX.header_lines(spark, _landed(spark, sf_dir) + "/{a,b,c}/*.csv")
    return heads.select("separador", "codificacao", "cabecalho").distinct()


@query("a23_landed_lines", with_views(MOV) + """SELECT CASE id % 3 WHEN 1 THEN ',' ELSE ';' END AS separador,
 CASE id % 3 WHEN 2 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS codificacao, CAST(count(*) AS BIGINT) AS linhas FROM mov GROUP BY ALL""")
def a23n(spark, sf_dir):
    """Data lines of the landed files by the separator and encoding found for their file."""
    status = TX.file_status(spark, _landed(spark, sf_dir) + "/{a,b,c}/*.csv")
    return status.groupBy("separador", "codificacao").agg(F.sum(F.col("linhas") - 1).alias("linhas")).where("linhas > 0")


@query("a17_landed_cnae", """WITH cnae AS (SELECT DISTINCT p_brand AS classe_cnae,
  CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) % 3 = 0 THEN 0 ELSE 1 END AS situacao FROM part)
SELECT classe_cnae AS code FROM cnae WHERE situacao = 1""")
def a17l(spark, sf_dir):
    path = scratch_path(spark, "cnae")
    (cnae_table(spark, sf_dir).select(F.concat(F.lit(" "), "classe_cnae").alias("CLASSE_CNAE"), F.col("situacao").alias("SITUACAO"))
     .write.option("header", True).option("sep", ";").csv(path))
    return C.load_cnae(spark, path)


@query("a22_landed_profile", with_views(MOV) + """SELECT separador, CAST(sum(linhas) AS BIGINT) AS linhas FROM (
 SELECT ';' AS separador, count(*) AS linhas FROM mov WHERE id % 3 = 0 UNION ALL SELECT ',', count(*) FROM mov WHERE id % 3 = 1
 UNION ALL SELECT ';', count(*) FROM mov WHERE id % 3 = 2) GROUP BY separador""")
def a22l(spark, sf_dir):
    prof = TX.profile_files(spark, _landed(spark, sf_dir) + "/{a,b,c}/*.csv").where("escolhido")
    return prof.groupBy("separador").agg((F.sum("linhas") - F.count(F.lit(1))).alias("linhas"))  # one header line per file


@query("c3_layout_years", with_views(MOV) + f"SELECT {_PCOLS} FROM mov WHERE substr(competencia_mov,1,4) IN ('2021','2023')")
def c3l(spark, sf_dir):
    return C.filter_period(spark.read.parquet(_layout(spark, sf_dir)), years=[2021, 2023]).select(*RT_COLS)


@query("n2_from_layout", FLAGSHIP_SQL)
def n2l(spark, sf_dir):
    return balance_from_layout(spark, _layout(spark, sf_dir))


# --- A12 / A18: sinks ------------------------------------------------------------------------------------

@query("a12_codec", with_views(MOV) + f"SELECT tipo, {_PART_SQL}, count(*) AS linhas FROM mov GROUP BY ALL")
def a12(spark, sf_dir):
    root = scratch_path(spark, "gzip")
    FL.write_monthly(mov(spark, sf_dir, RT_COLS), root, compression="gzip")
    df = spark.read.parquet(root)
    return df.groupBy("tipo", "ano", "mes").agg(F.count(F.lit(1)).alias("linhas"))


@query("a12_codec_values", RT_SQL)
def a12v(spark, sf_dir):
    """All values through two codecs, one after the other."""
    first, second = scratch_path(spark, "zstd"), scratch_path(spark, "gzip")
    FL.write_monthly(mov(spark, sf_dir, RT_COLS), first, compression="zstd")
    FL.write_monthly(FL.read_period(spark, first), second, compression="gzip")
    return FL.read_period(spark, second).select(*RT_COLS)


def _a18(spark, sf_dir):
    from jobflow.plans.balance_queries import flagship
    return FL.write_balance(flagship(spark, sf_dir), scratch_path(spark, "saldo"))


query("a18_write_balance", FLAGSHIP_SQL)(_a18)


@query("a18_republish", FLAGSHIP_SQL)
def a18r(spark, sf_dir):
    """The second version is computed from the first, which its readers keep."""
    root = scratch_path(spark, "saldo")
    FL.write_balance(B.monthly_balance(mov(spark, sf_dir, BAL_COLS)), root)
    FL.write_balance(B.running_stock(FL.read_balance(spark, root)), root)
    return FL.read_balance(spark, root)
