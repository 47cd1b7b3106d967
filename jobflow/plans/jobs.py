"""Composed jobs (N1 monthly ingest, N2 balance series, N3 incremental balance over the layout)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobflow.functions import clean as CL
from jobflow.functions import names as NM
from jobflow.operators import balance as B
from jobflow.operators import filters as C
from jobflow.operators import quality as Q
from jobflow.operators.windows import month_date
from jobflow.session import scratch_path
from jobflow.sources import files as FL
from jobflow.sources import text as TX
from jobflow.sources import versions as VS
from jobflow.streaming import incremental as INC


INVALID_LINE, INVALID_MONTH = "linha_malformada", "competencia_invalida"
REJECTED = "arquivo string, linha string, motivo string"


def monthly_job(spark: SparkSession, paths, out_root: str, *, types: dict[str, str] | None = None,
                chain: C.FilterChain | None = None, report_checks: list[Q.Check] | None = None,
                month: str = "COMPETENCIA_MOV", run: str | None = None) -> DataFrame | None:
    """Read text -> canonical names -> typed columns -> filters -> quality report -> partitioned write.

    Files may differ in column order, separator and encoding; each is read by its own header.  The
    period is the month column, or the one in the file's name (``MOV202103...``) where the column is absent
    or empty.  Nothing vanishes: a file that is empty, unreadable, truncated or without a known separator is left out whole and listed,
    and lines with a wrong number of fields and rows without a valid month are kept verbatim, all in this run's folder of
    ``<out_root>_quarentena`` (arquivo, linha - null for a whole file -, motivo).  Runs keep their folders; running
    again under the same ``run`` replaces its own.  Returns the quality report (or None).

    The text is parsed once, into a stored table that the layout, the quarantine and the report read.
    """
    status = TX.file_status(spark, paths)
    quarantine = FL.quarantine_path(out_root, run or FL.new_run())
    files = status.where(F.col("motivo").isNotNull()).select("arquivo", F.lit(None).cast("string").alias("linha"), "motivo")
    raw = TX.read_grouped(spark, paths, status)
    data = [c for c in raw.columns if c not in (TX.CORRUPT, "_arquivo")]
    if not data:  # no file can be read
        files.write.mode("overwrite").parquet(quarantine)
        return None
    name = F.element_at(F.split("_arquivo", "/"), -1)
    by_name = F.nullif(F.regexp_extract(name, r"(?:MOV|EXC|FOR)(\d{6})", 1), F.lit(""))
    own = F.nullif(F.trim(F.col(month)), F.lit("")) if month in data else F.lit(None).cast("string")
    period = F.coalesce(own, by_name)
    reason = (F.when(F.col(TX.CORRUPT).isNotNull(), INVALID_LINE)
              .when(month_date(period).isNull(), INVALID_MONTH))
    rows = raw.withColumn(month, period).withColumn("__motivo", reason)
    if "TIPO" not in data:
        rows = rows.withColumn("TIPO", F.nullif(F.regexp_extract(name, r"(MOV|EXC|FOR)\d{6}", 1), F.lit("")))
        data = [*data, "TIPO"]
    data = list(dict.fromkeys([*data, month]))
    path = scratch_path(spark, "monthly")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    df = NM.with_period(rows.where("__motivo IS NULL").select(*data), month_col=month)
    if types:
        df = CL.apply_schema(df, types)
    if chain is not None:
        df = chain.apply(df)
    report = Q.QualityReport(df, report_checks).run() if report_checks else None
    lower = df.select(*[F.col(c).alias(c.lower()) for c in df.columns]).drop("ano", "mes")
    FL.write_monthly(lower, out_root, month=month.lower())
    bad = rows.where("__motivo IS NOT NULL").select(
        F.col("_arquivo").alias("arquivo"),
        F.coalesce(F.col(TX.CORRUPT), F.to_json(F.struct(*data))).alias("linha"), F.col("__motivo").alias("motivo"))
    bad.unionByName(files).write.mode("overwrite").parquet(quarantine)
    return report


def rejected(spark: SparkSession, out_root: str) -> DataFrame:
    """Rejected files and lines of all runs of :func:`monthly_job` (arquivo, linha, motivo, execucao)."""
    return spark.read.schema(f"{REJECTED}, execucao string").parquet(FL.quarantine_path(out_root))


def standard_movements(spark: SparkSession, root: str, periods: list[tuple[int, int]] | None = None) -> DataFrame:
    """The movements of the written tipo/ano/mes layout: period scan (A7), the 33 standard columns (B10), and the three
    sources tagged and stacked (B18, B19, H1).  Exclusions are inverted."""
    sources = {}
    for tipo in ("MOV", "EXC", "FOR"):
        part = FL.read_period(spark, root, periods, tipo).drop("tipo", "ano", "mes")
        sources[tipo] = NM.align(NM.canonical_names(part))
    stacked = B.union_sources(sources["MOV"], sources["EXC"], sources["FOR"], saldo="SALDO_MOVIMENTACAO")
    return stacked.select(*[F.col(c).alias(c.lower()) for c in stacked.columns]).withColumn("tipo", F.lit("MOV"))


def balance_from_layout(spark: SparkSession, root: str, periods: list[tuple[int, int]] | None = None, **kw) -> DataFrame:
    """N2 from the written layout: its standard movements into the balance series."""
    return B.balance_series(standard_movements(spark, root, periods), **kw)


def balance_series(mov: DataFrame, **kw) -> DataFrame:
    """N2 (alias of the operator chain)."""
    return B.balance_series(mov, **kw)


LEDGER = "tipo string, ano int, mes int, arquivos bigint, bytes bigint, assinatura bigint"


def layout_ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per directory of the layout: its number of files, their bytes, and a signature of names, sizes and times.

    Only the file listing is read.  A directory that a later write has replaced gets another signature.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
    sign = F.xxhash64(F.element_at(F.split("path", "/"), -1), "length", "modificationTime")
    return (files.groupBy(part("tipo").alias("tipo"), part("ano").try_cast("int").alias("ano"), part("mes").try_cast("int").alias("mes"))
            .agg(F.count("*").alias("arquivos"), F.sum("length").alias("bytes"), F.bit_xor(sign).alias("assinatura")))


def pending_months(layout: DataFrame, done: DataFrame) -> list[tuple[int, int]]:
    """Months of the layout's ledger with a directory that ``done`` lacks or has with another signature, or that is gone."""
    same = ["tipo", "ano", "mes", "assinatura"]
    new, gone = layout.join(done, same, "left_anti"), done.join(layout, ["tipo", "ano", "mes"], "left_anti")
    months = new.select("ano", "mes").union(gone.select("ano", "mes")).where("ano IS NOT NULL AND mes IS NOT NULL").distinct()
    return sorted((r["ano"], r["mes"]) for r in months.collect())  # a calendar's worth of rows


def balance_job(spark: SparkSession, root: str, store: str, *, keep: int = 3, **stock_kw) -> DataFrame:
    """Bring the balance series in ``store`` up to date with the layout at ``root``, reading only months that are new or were rewritten.

    The store is a versioned dataset of three tables that become visible together: ``razao`` (the ledger of directories
    already counted), ``estado`` (signed sums per directory month and movement month) and ``serie`` (the balance with its stock).  Nothing new
    publishes nothing.  A run that fails leaves the last version as it is, and the next run does its months again.
    """
    last = VS.current(spark, store)
    now = layout_ledger(spark, root)
    done = VS.read(spark, store, "razao") if last is not None else spark.createDataFrame([], LEDGER)
    todo = pending_months(now, done)
    if not todo and last is not None:
        return VS.read(spark, store, "serie")
    delta = month_deltas(spark, root, todo)
    if last is not None:
        months = spark.createDataFrame(todo, "ano int, mes int")
        delta = VS.read(spark, store, "estado").join(months, ["ano", "mes"], "left_anti").unionByName(delta)
    path = scratch_path(spark, "balance-state")
    delta.write.parquet(path)  # the series and the stored state come from one computation
    state = spark.read.schema(delta.schema).parquet(path)
    total = state.groupBy("competencia").agg(F.sum("adm_liq").alias("adm_liq"), F.sum("desl_liq").alias("desl_liq"))
    number = VS.publish(spark, store, {"razao": now, "estado": state, "serie": INC.series_from_state(total, **stock_kw)},
                        expected=-1 if last is None else last, keep=keep)
    return VS.read(spark, store, "serie", number)


def month_deltas(spark: SparkSession, root: str, months: list[tuple[int, int]]) -> DataFrame:
    """Signed sums (ano, mes, competencia, adm_liq, desl_liq) of the given directory months, which alone are scanned."""
    parts = []
    for tipo in ("MOV", "EXC", "FOR"):
        part = FL.read_period(spark, root, months, tipo) if months else FL.read_period(spark, root).where(F.lit(False))
        own = part.select(F.col("ano").alias("__ano"), F.col("mes").alias("__mes"), *[c for c in part.columns if c not in FL.PARTITIONS])
        named = NM.canonical_names(own.drop("__ano", "__mes"))
        cols = ["COMPETENCIA_MOV", "TIPO_MOVIMENTACAO", "SALDO_MOVIMENTACAO"]
        missing = [c for c in cols if c not in named.columns]
        if missing:
            raise ValueError(f"{root}: {tipo} has no {missing}")
        source = dict(zip(named.columns, [c for c in own.columns if c not in ("__ano", "__mes")], strict=True))
        parts.append(own.select(F.col("__ano").cast("int").alias("ano"), F.col("__mes").cast("int").alias("mes"), F.lit(tipo).alias("tipo"),
                                *[F.col(f"`{source[c]}`").alias(c.lower()) for c in cols]))
    return INC.signed_delta(reduce(DataFrame.unionByName, parts), by=("ano", "mes"))
