"""Parquet layout, writers and consolidation.

Layout: ``root/tipo=<MOV|EXC|FOR>/ano=<YYYY>/mes=<M>/part-*.parquet``.  Reads
scan the requested directories only; writes use dynamic partition
overwrite, so re-running one month replaces exactly that month and a job
retried after a lost executor is idempotent.

Months may have other columns, or other types of one column, than their neighbours: a read has
the columns of every month that it covers (null where a month lacks one), of a type that
holds all of them.
"""

from __future__ import annotations

import re
import time
import uuid
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobflow.operators.windows import month_date
from jobflow.session import scratch_path
from jobflow.sources import versions as VS
from jobflow.sources.text import CORRUPT, file_status, listed_files, plain_path, read_grouped

PARTITIONS = ["tipo", "ano", "mes"]


def with_partition_columns(df: DataFrame, *, month: str = "competencia_mov", tipo: str = "tipo") -> DataFrame:
    """Derive (tipo, ano, mes) partition values; type defaults to MOV, a value that is no month gives nulls."""
    c = month_date(F.col(month).cast("string"))
    t = F.coalesce(F.col(tipo), F.lit("MOV")) if tipo in df.columns else F.lit("MOV")
    return df.withColumns({"tipo": t, "ano": F.year(c), "mes": F.month(c)})


def write_monthly(df: DataFrame, root: str, *, compression: str = "snappy", month: str = "competencia_mov") -> None:
    """One directory per type and month; only the months present in ``df`` are replaced.

    Rows are clustered by the partition columns with the ``rebalance`` hint:
    AQE groups each (type, month) into few tasks - so each directory gets few
    files - but splits a partition value that is too large (a month holding a
    third of the data is spread over many tasks instead of one) and merges
    small ones.  A plain ``repartition(tipo, ano, mes)`` would send a whole
    month to a single task.
    """
    out = with_partition_columns(df, month=month)
    (out.hint("rebalance", *PARTITIONS)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", compression)
     .partitionBy(*PARTITIONS).parquet(root))


# the write job that made a file; all its files have one schema
_JOB = re.compile(r"part-\d+-([0-9a-f-]{36})")
_VALUE = {p: re.compile(rf"/{p}=([^/]*)/") for p in PARTITIONS}


def layout_files(spark: SparkSession, root: str, periods: list[tuple[int, int]] | None = None,
                 tipo: str | list[str] | None = None) -> list[str]:
    """Files of the layout in the directories of the given (year, month) pairs and type(s); names only, no data is read."""
    pairs = None if not periods else {(str(y), str(m)) for y, m in periods}
    types = None if tipo is None else {tipo} if isinstance(tipo, str) else set(tipo)
    found = []
    for f in map(unquote, spark.read.parquet(root).inputFiles()):
        t, y, m = (x.group(1) if (x := _VALUE[p].search(f)) else None for p in PARTITIONS)
        if (types is None or t in types) and (pairs is None or (y, m) in pairs):
            found.append(f)
    return sorted(found)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both: whole numbers widen, with decimals they become double,
    a date and a timestamp a timestamp; anything else becomes text."""
    whole = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in whole and b in whole:
        return whole[max(whole.index(a), whole.index(b))]
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def stack(frames: list[DataFrame]) -> DataFrame:
    """Union by name (upper and lower case alike): all columns of all frames, each of a type that holds every frame's."""
    names: dict[str, str] = {}
    types: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            low = f.name.lower()
            types[low] = common_type(types[low], f.dataType) if low in types else f.dataType
            names.setdefault(low, f.name)

    def whole(df: DataFrame) -> DataFrame:
        own = {c.lower(): c for c in df.columns}
        return df.select(*[(F.col(f"`{own[low]}`") if low in own else F.lit(None)).cast(types[low]).alias(name)
                           for low, name in names.items()])
    return reduce(DataFrame.unionByName, [whole(df) for df in frames])


def read_period(spark: SparkSession, root: str, periods: list[tuple[int, int]] | None = None,
                tipo: str | list[str] | None = None) -> DataFrame:
    """Read the (year, month) pairs requested (not the years x months product) for the given type(s).

    All columns of the months read are kept.  The footers are merged by Spark in parallel; only where
    months disagree about a column's type is one footer per write job read, and jobs of one schema are
    scanned together and cast to the common type.  Nothing selected gives an empty frame with the layout's columns.
    """
    files = layout_files(spark, root, periods, tipo)
    if not files:
        return spark.read.parquet(root).where(F.lit(False))

    def scan(paths: list[str], merge: bool) -> DataFrame:
        return spark.read.option("basePath", root).option("mergeSchema", str(merge).lower()).parquet(*paths)

    try:
        return scan(sorted({f.rpartition("/")[0] for f in files}), True)
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
    jobs: dict[str, list[str]] = {}
    for f in files:
        job = _JOB.search(f.rpartition("/")[2])
        jobs.setdefault(job.group(1) if job else f, []).append(f)
    schemas: dict[str, list[str]] = {}
    for paths in jobs.values():
        schemas.setdefault(scan(paths[:1], False).schema.json(), []).extend(paths)
    whole = stack([scan(paths, False) for paths in schemas.values()])
    return whole.select(*[c for c in whole.columns if c not in PARTITIONS], *PARTITIONS)


def consolidate_month(dfs: list[DataFrame]) -> DataFrame:
    """Stack all files of one month by column name (missing columns -> null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# fixed values: sort-column candidates of the annual consolidation, in priority order
SORT_CANDIDATES = ["data_movimentacao", "competencia_mov", "data"]


def sort_column(df: DataFrame, candidates=SORT_CANDIDATES) -> str | None:
    """First present candidate, case-insensitive."""
    low = {c.lower(): c for c in df.columns}
    for c in candidates:
        if c.lower() in low:
            return low[c.lower()]
    return None


def consolidate(spark: SparkSession, root: str, years: list[int], out: str, *, compression: str = "snappy",
                candidates=SORT_CANDIDATES) -> str:
    """Stack every month of ``years`` (all types) and write one range-named dataset,
    sorted by the first present date column.

    Sorting is ``repartitionByRange`` + ``sortWithinPartitions`` (sampled range
    boundaries, no single-task sort).  The range key is the sort column followed
    by the remaining columns, so one very frequent date value is still split
    across several tasks.  Every column of every month is kept.  Inputs are never deleted.
    """
    df = read_period(spark, root, [(y, m) for y in years for m in range(1, 13)])
    key = sort_column(df, candidates)
    if key is not None:
        rest = [c for c in df.columns if c != key]
        df = df.repartitionByRange(key, *rest).sortWithinPartitions(key, *rest)
    name = f"{out.rstrip('/')}/consolidado_{min(years)}_{max(years)}" if len(years) > 1 else \
        f"{out.rstrip('/')}/consolidado_{years[0]}"
    df.write.mode("overwrite").option("compression", compression).parquet(name)
    return name


def per_file_counts(spark: SparkSession, paths, *, fmt: str = "parquet") -> DataFrame:
    """Read many files at once with per-file row counts; an unreadable or empty file is listed with
    0 rows and its reason instead of vanishing."""
    df = spark.read.format(fmt).option("ignoreCorruptFiles", "true").load(paths)
    counted = df.groupBy(F.col("_metadata.file_path").alias("arquivo")).agg(F.count(F.lit(1)).alias("linhas"))
    return with_reasons(spark, paths, counted)


def with_reasons(spark: SparkSession, paths, counted: DataFrame) -> DataFrame:
    """All files under ``paths`` (metadata only) with their counted rows, and a reason where there are none."""
    listing = listed_files(spark, paths).withColumnRenamed("_p", "__path")
    counted = counted.select(plain_path("arquivo").alias("__path"), "linhas")
    reason = F.when(F.col("linhas").isNull(), F.when(F.col("bytes") == 0, "vazio").otherwise("ilegivel_ou_sem_linhas"))
    return (listing.join(counted, "__path", "left").select(
        "arquivo", "bytes", F.coalesce("linhas", F.lit(0).cast("bigint")).alias("linhas"), reason.alias("motivo")))


def quarantine_path(out_root: str, run: str | None = None) -> str:
    """Folder of the rejected lines of ``out_root``, or of one run of it; runs never overwrite each other."""
    whole = f"{out_root.rstrip('/')}_quarentena"
    return whole if run is None else f"{whole}/execucao={run}"


def new_run() -> str:
    """Name of a run, in order of time."""
    return f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"


def convert_many(spark: SparkSession, paths, out_root: str, *, run: str | None = None) -> DataFrame:
    """Convert delimited files of any header, separator and encoding to Parquet, one directory per file.

    Returns one row per input file: arquivo, bytes, linhas (converted), ruins (lines with a wrong number of fields), motivo (null, or
    why the file was not converted; no row of such a file is).  The bad lines go to the run's folder of
    ``<out_root>_quarentena``.  The files are parsed once, into a stored table that both outputs are written from.
    """
    status = file_status(spark, paths)
    path = scratch_path(spark, "convert")
    read_grouped(spark, paths, status).write.parquet(path)
    rows = spark.read.parquet(path)
    data = [c for c in rows.columns if c not in (CORRUPT, "_arquivo")]
    good = rows.where(F.col(CORRUPT).isNull())
    if data:
        (good.select(*data, F.regexp_replace(F.element_at(F.split("_arquivo", "/"), -1), r"\.[^.]*$", "").alias("arquivo"))
         .hint("rebalance", "arquivo").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("arquivo").parquet(out_root))
    (rows.where(F.col(CORRUPT).isNotNull()).select(F.col("_arquivo").alias("arquivo"), F.col(CORRUPT).alias("linha"))
     .write.mode("overwrite").parquet(quarantine_path(out_root, run or new_run())))
    counted = rows.groupBy(plain_path("_arquivo").alias("__path")).agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("linhas"), F.count_if(F.col(CORRUPT).isNotNull()).alias("ruins"))
    none = F.lit(0).cast("bigint")
    return (status.select("arquivo", "bytes", "motivo", plain_path("arquivo").alias("__path")).join(counted, "__path", "left")
            .select("arquivo", "bytes", F.coalesce("linhas", none).alias("linhas"), F.coalesce("ruins", none).alias("ruins"), "motivo"))


def preview(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """First n rows under a total order (deterministic)."""
    return df.orderBy(*(order or df.columns)).limit(n)


def write_balance(df: DataFrame, root: str, *, keep: int = 3) -> DataFrame:
    """Publish the balance series as the next version of the dataset at ``root`` and return it read back.

    The series may be computed from the version that it replaces.  A reader sees one whole version, during a write
    and after a failed one; ``keep`` versions stay.
    """
    spark = df.sparkSession
    return VS.read(spark, root, "saldo", VS.publish(spark, root, {"saldo": df}, keep=keep))


def read_balance(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a series that :func:`write_balance` published."""
    return VS.read(spark, root, "saldo")
