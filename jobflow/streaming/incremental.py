"""Incremental pick-up (K1) and retroactive balance updates.

Late declarations and exclusions can change months years back, so a
watermark would drop valid rows.  Instead each micro-batch is reduced to a
per-month delta (a tiny frame: one row per month touched) and merged into
the stored series; the stock is recomputed on the small series.  State is a
versioned dataset (``sources.versions``): version k+1 is
published from version k plus batch k, a replayed batch finds its version
there and changes nothing, and only the last few versions stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobflow.functions.codes import ADMISSION, SEPARATION, direction
from jobflow.operators.analytics import lateness_counts, lateness_of
from jobflow.operators.balance import running_stock, signed_balance
from jobflow.sources import versions as VS

SIGNED = ["competencia", "adm_liq", "desl_liq"]


def incremental_read(spark: SparkSession, root: str, checkpoint: str, sink: str, *,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """K1: pick up every file not yet seen under ``root`` (file-source checkpoint), append it to
    ``sink`` exactly once, stop when caught up (``availableNow``), and return the sink contents.  Columns that only some
    months have are kept; months that disagree about a type are an error."""
    schema = spark.read.option("mergeSchema", "true").parquet(root).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (r.parquet(root).writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .option("path", sink).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(schema).parquet(sink)


def signed_delta(df: DataFrame, *, month="competencia_mov", code="tipo_movimentacao", tipo="tipo",
                 saldo="saldo_movimentacao", by=()) -> DataFrame:
    """Per-month signed sums of admissions and separations (the mergeable state of E2), kept apart by the ``by`` columns."""
    d = direction(F.col(code))
    s = signed_balance(F.col(tipo), F.col(saldo))
    return (df.where(d.isNotNull()).groupBy(*by, F.col(month).cast("string").alias("competencia"))
            .agg(F.sum(F.when(d == ADMISSION, s).otherwise(0)).cast("bigint").alias("adm_liq"),
                 F.sum(F.when(d == SEPARATION, s).otherwise(0)).cast("bigint").alias("desl_liq")))


def merge_delta(state: DataFrame, delta: DataFrame) -> DataFrame:
    """Add a delta to the signed state month by month (months new to the state are inserted)."""
    return (state.select(*SIGNED).unionByName(delta.select(*SIGNED))
            .groupBy("competencia").agg(F.sum("adm_liq").cast("bigint").alias("adm_liq"),
                                        F.sum("desl_liq").cast("bigint").alias("desl_liq")))


def series_from_state(state: DataFrame, **stock_kw) -> DataFrame:
    """Signed state -> (competencia, admissoes, desligamentos, saldo_mensal, estoque)."""
    bal = state.select("competencia", F.col("adm_liq").alias("admissoes"), F.abs("desl_liq").alias("desligamentos"),
                       (F.col("adm_liq") - F.abs("desl_liq")).alias("saldo_mensal"))
    return running_stock(bal, **stock_kw)


def write_state(state: DataFrame, state_dir: str, version: int = 0) -> None:
    """Publish one version of the signed state (version 0 = the initial series)."""
    VS.publish(state.sparkSession, state_dir, {"estado": state.select(*SIGNED)}, version=version)


def latest_state(spark: SparkSession, state_dir: str) -> DataFrame:
    """The current version of the state."""
    return VS.read(spark, state_dir, "estado").select(*SIGNED)


def retro_update(spark: SparkSession, landing: str, state_dir: str, checkpoint: str, schema, *,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """K2: stream late/exclusion files from ``landing``; each micro-batch's per-month delta is
    merged into the versioned signed state under ``state_dir`` (version 0 must exist).
    Returns the final balance series with the stock recomputed."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch_id + 1 in VS.versions(spark, state_dir):
            return  # a replay
        prev = VS.read(spark, state_dir, "estado", batch_id).select(*SIGNED)
        write_state(merge_delta(prev, signed_delta(batch)), state_dir, batch_id + 1)

    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (r.parquet(landing).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return series_from_state(latest_state(spark, state_dir))


def lateness_stream(spark: SparkSession, landing: str, out: str, checkpoint: str, schema, *,
                    max_files_per_trigger: int | None = None, keep: int = 3) -> DataFrame:
    """K3 on a stream: files that land under ``landing`` are added to per-month sums kept in the state store; every micro-batch
    publishes the whole result (a row per month) as a version of ``out``.  Returns the lateness after all files seen so far.

    There is no watermark, since late rows may reach any month; the state is one row per month.  A
    replayed batch finds its version published.  Calling again continues from the checkpoint.
    """

    def emit(batch: DataFrame, batch_id: int) -> None:
        VS.publish(spark, out, {"atraso": batch}, version=batch_id, keep=keep)

    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (lateness_counts(r.parquet(landing)).writeStream.outputMode("complete").foreachBatch(emit)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return lateness_of(VS.read(spark, out, "atraso"))


def balance_incremental(state: DataFrame, new_rows: DataFrame, **stock_kw) -> DataFrame:
    """N3 in batch: stored signed state + rows declared since it was computed (any movement
    month, so late rows reach old months) -> full series with stock recomputed."""
    return series_from_state(merge_delta(state, signed_delta(new_rows)), **stock_kw)
