"""Incremental and streaming keys (K1, K2, N1, N3) and file hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobflow.operators import filters as C
from jobflow.plans.balance_queries import BAL_COLS, FLAGSHIP_SQL
from jobflow.plans import analytics_queries  # noqa: F401 - its oracle of K3 is shared
from jobflow.plans import registry
from jobflow.plans.registry import query
from jobflow.plans.source_queries import _DAMAGED, _LANDED, DAMAGED_SQL, RT_COLS, _damaged, _landed, _layout, moves
from jobflow.plans.sql import MOV, with_views
from jobflow.plans.jobs import balance_job, monthly_job, rejected
from jobflow.session import scratch_path
from jobflow.sources import files as FL
from jobflow.sources.tables import mov, table
from jobflow.sources.text import file_hashes, text_hashes
from jobflow.streaming import incremental as INC

_PART_SQL = "CAST(substr(competencia_mov,1,4) AS INTEGER) AS ano, CAST(substr(competencia_mov,5,2) AS INTEGER) AS mes"


@query("k1_incremental", with_views(MOV) + "SELECT " + ", ".join(RT_COLS) + f", {_PART_SQL} FROM mov")
def k1(spark, sf_dir):
    root = _layout(spark, sf_dir)
    out = INC.incremental_read(spark, root, scratch_path(spark, "k1-ckpt"), scratch_path(spark, "k1-sink"))
    return out.select(*RT_COLS, "ano", "mes")


@query("k2_retro_update", FLAGSHIP_SQL)
def k2(spark, sf_dir):
    m = moves(spark, sf_dir, BAL_COLS)
    state_dir, landing = scratch_path(spark, "k2-state"), scratch_path(spark, "k2-landing")
    INC.write_state(INC.signed_delta(m.where(F.col("tipo") == "MOV")), state_dir, 0)
    # late declarations land first, exclusions later: two arrivals, several files each
    m.where(F.col("tipo") == "FOR").repartition(3).write.parquet(landing + "/chegada=1")
    m.where(F.col("tipo") == "EXC").repartition(3).write.parquet(landing + "/chegada=2")
    schema = spark.read.parquet(landing).schema
    return INC.retro_update(spark, landing, state_dir, scratch_path(spark, "k2-ckpt"), schema, max_files_per_trigger=2)


@query("n3_incremental", FLAGSHIP_SQL)
def n3(spark, sf_dir):
    m = mov(spark, sf_dir, BAL_COLS + ["competencia_dec"])
    state = INC.signed_delta(m.where(F.col("competencia_dec") <= "202312"))
    return INC.balance_incremental(state, m.where(F.col("competencia_dec") > "202312"))


@query("n3_job", FLAGSHIP_SQL)
def n3j(spark, sf_dir):
    """Three runs of the job: the months until 2021, one of them without its late rows; the later months; then that month again, whole."""
    root, store, m = scratch_path(spark, "n3-layout"), scratch_path(spark, "n3-store"), moves(spark, sf_dir, RT_COLS)
    month, late = F.col("competencia_mov"), F.lit("202103")
    FL.write_monthly(m.where((month <= "202112") & ((month != late) | (F.col("tipo") == "MOV"))), root)
    balance_job(spark, root, store)
    FL.write_monthly(m.where(month > "202112"), root)
    balance_job(spark, root, store)
    FL.write_monthly(m.where(month == late), root)
    return balance_job(spark, root, store)


@query("k3_stream", registry.ORACLE["k3_lateness"])
def k3s(spark, sf_dir):
    """Two arrivals, each its own run of the stream."""
    m = mov(spark, sf_dir, ["id", "competencia_mov", "competencia_dec"])
    landing, out, ckpt = (scratch_path(spark, f"k3-{x}") for x in ("landing", "out", "ckpt"))
    for k in (0, 1):
        m.where(F.pmod("id", F.lit(3)).isin([0] if k else [1, 2])).write.parquet(f"{landing}/chegada={k}")
        got = INC.lateness_stream(spark, landing, out, ckpt, m.schema, max_files_per_trigger=2)
    return got


N1_YEARS = [2021, 2022]


@query("n1_monthly", with_views(MOV) + f"SELECT tipo, {_PART_SQL}, count(*) AS linhas, CAST(sum(saldo_movimentacao) AS BIGINT) AS saldo, "
       "CAST(round(sum(CAST(round(salario * 100) AS BIGINT)) / 100.0, 2) AS DOUBLE) AS salarios "
       "FROM mov WHERE substr(competencia_mov,1,4) IN ('2021','2022') GROUP BY ALL")
def n1(spark, sf_dir):
    """Files of different column order, separator and encoding, one with malformed lines and months, by one job."""
    out = scratch_path(spark, "n1")
    chain = C.FilterChain().period(col="COMPETENCIA_MOV", years=N1_YEARS)
    monthly_job(spark, _landed(spark, sf_dir) + _LANDED, out, types={"SALDO_MOVIMENTACAO": "int", "CNPJ": "bigint", "SALARIO": "double"},
                chain=chain)
    w = spark.read.parquet(out)
    cents = F.sum(F.round(F.col("salario") * 100).cast("bigint"))
    return w.groupBy("tipo", "ano", "mes").agg(F.count(F.lit(1)).alias("linhas"), F.sum("saldo_movimentacao").cast("bigint").alias("saldo"),
                                               F.round(cents / 100.0, 2).alias("salarios"))


@query("n1_quarantine", "SELECT 'linha_malformada' AS motivo, count(*) AS n FROM customer UNION ALL "
       "SELECT 'competencia_invalida', count(*) FROM customer WHERE c_custkey % 4 = 0")
def n1q(spark, sf_dir):
    out = scratch_path(spark, "n1q")
    monthly_job(spark, _landed(spark, sf_dir) + _LANDED, out, types={"SALDO_MOVIMENTACAO": "int"})
    return rejected(spark, out).where("linha IS NOT NULL").groupBy("motivo").agg(F.count(F.lit(1)).alias("n"))


@query("n1_rejected", with_views(MOV) + "SELECT motivo, CAST(1 AS BIGINT) AS execucao, count(*) AS n FROM " + DAMAGED_SQL.format(", ('so_cabecalho')") +
       """ GROUP BY motivo UNION ALL SELECT 'linha_malformada', 2, count(*) FROM customer
 UNION ALL SELECT 'competencia_invalida', 2, count(*) FROM customer WHERE c_custkey % 4 = 0""")
def n1x(spark, sf_dir):
    """Two runs of the job into one layout: rejected files of the first, rejected lines of the second."""
    out = scratch_path(spark, "n1x")
    monthly_job(spark, _damaged(spark, sf_dir) + _DAMAGED, out, run="1")
    monthly_job(spark, _landed(spark, sf_dir) + "/{a,b,c,d}/*.{csv,txt}", out, run="2")
    r = rejected(spark, out).withColumn("execucao", F.col("execucao").cast("bigint"))
    return r.where("execucao = 1 OR linha IS NOT NULL").groupBy("motivo", "execucao").agg(F.count("*").alias("n"))


@query("e18_hash", "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes, sha256(text) AS sha256, md5(text) AS md5 FROM documents")
def e18(spark, sf_dir):
    return text_hashes(table(spark, sf_dir, "documents"), "text", keep=["doc_id"])


@query("e18_file_hash", "SELECT CAST(strlen(t) AS BIGINT) AS bytes, sha256(t) AS sha256, md5(t) AS md5 FROM "
       "(SELECT string_agg(n_name || chr(10), '' ORDER BY n_name) AS t FROM nation)")
def e18f(spark, sf_dir):
    out = scratch_path(spark, "e18")
    table(spark, sf_dir, "nation").select("n_name").coalesce(1).sortWithinPartitions("n_name").write.text(out)
    return file_hashes(spark, out + "/*.txt").drop("arquivo")


def _n1_checks():
    from jobflow.operators import quality as Q
    return [Q.domain("TIPO_MOVIMENTACAO", Q.MOVEMENT_DOMAIN, "tipos_movimentacao"), Q.negatives("SALARIO"),
            Q.period_format("COMPETENCIA_MOV")]


def _n1_report_sql():
    from jobflow.operators import quality as Q
    from jobflow.plans.quality_queries import _fin, chk, union
    dom = ", ".join(f"'{c}'" for c in Q.MOVEMENT_DOMAIN)
    src = "f"
    rep = union(chk("tipos_movimentacao", "TIPO_MOVIMENTACAO", f"TIPO_MOVIMENTACAO NOT IN ({dom})",
                    "TIPO_MOVIMENTACAO IS NOT NULL", 0.0, src),
                chk("valores_negativos", "SALARIO", "SALARIO < 0", "SALARIO IS NOT NULL", 0.0, src),
                chk("formato_periodo", "COMPETENCIA_MOV",
                    r"NOT regexp_matches(COMPETENCIA_MOV, '^\d{4}-\d{2}$|^\d{6}$|^\d{4}/\d{2}$')",
                    "COMPETENCIA_MOV IS NOT NULL", 0.0, src))
    geral = _fin("SELECT 'geral' AS check_name, '*' AS column_name, CAST(count_if(status = 'falha') AS BIGINT) AS bad_rows, "
                 "CAST(count(*) AS BIGINT) AS total_rows, CAST(0.0 AS DOUBLE) AS tolerance FROM rep")
    return (with_views(MOV) + ", f AS (SELECT tipo_movimentacao AS TIPO_MOVIMENTACAO, salario AS SALARIO, "
            "competencia_mov AS COMPETENCIA_MOV FROM mov WHERE substr(competencia_mov,1,4) IN ('2021','2022')), "
            f"rep AS ({rep})\n" + union("SELECT * FROM rep", geral))


@query("n1_monthly_report", _n1_report_sql())
def n1r(spark, sf_dir):
    out = scratch_path(spark, "n1r")
    chain = C.FilterChain().period(col="COMPETENCIA_MOV", years=[2021, 2022])
    return monthly_job(spark, _landed(spark, sf_dir) + _LANDED, out,
                       types={"SALDO_MOVIMENTACAO": "int", "CNPJ": "bigint", "SALARIO": "double"},
                       chain=chain, report_checks=_n1_checks())
