"""Operation-log analytics (E19-E23, G7 lives in ranking).

The log is a DataFrame (operation, success, duration, ts, item_id, details);
every reference time is a parameter, never "now", so results are
reproducible.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: alert thresholds
ALERT_MIN_RUNS = 5
ALERT_RATE = 0.8
CRITICAL_RATE = 0.5
THROUGHPUT_MAX_FAILURE_PCT = 20.0
THROUGHPUT_MAX_SECONDS = 300.0
THROUGHPUT_MIN_FILES_PER_SEC = 0.5


def op_metrics(log: DataFrame) -> DataFrame:
    """Per operation and overall ('geral' via ROLLUP): runs, successes, failures,
    total/mean/min/max duration, success rate."""
    cs = F.round(F.col("duration") * 100).cast("bigint")     # exact centiseconds: order-free sums
    g = log.rollup("operation").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("success").alias("sucesso"),
        F.count_if(~F.col("success")).alias("falhas"),
        (F.sum(cs).cast("double") / 100.0).alias("duracao_total"),
        (F.sum(cs).cast("double") / F.count(cs) / 100.0).alias("duracao_media"),
        F.min("duration").alias("duracao_min"), F.max("duration").alias("duracao_max"),
        F.grouping("operation").alias("_g"))
    return g.select(F.when(F.col("_g") == 1, F.lit("geral")).otherwise(F.col("operation")).alias("operation"),
                    "total", "sucesso", "falhas", "duracao_total", "duracao_media", "duracao_min", "duracao_max",
                    F.round(F.col("sucesso") / F.col("total"), 6).alias("taxa_sucesso"))


def op_alerts(spark: SparkSession, log: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Rate alert ('alerta' < 0.8 with > 5 runs, 'critico' <= 0.5) and slow runs above a
    per-operation duration limit.  The limits table is built from the given dict
    (one row per operation), so its broadcast is size-bounded by construction."""
    m = op_metrics(log).where(F.col("operation") != "geral")
    nivel = (F.when((F.col("total") > ALERT_MIN_RUNS) & (F.col("taxa_sucesso") <= CRITICAL_RATE), "critico")
             .when((F.col("total") > ALERT_MIN_RUNS) & (F.col("taxa_sucesso") < ALERT_RATE), "alerta").otherwise("ok"))
    out = m.select("operation", "total", "taxa_sucesso", nivel.alias("nivel"))
    if limits:
        lim = spark.createDataFrame(list(limits.items()), "operation string, limite double")
        slow = (log.join(F.broadcast(lim), "operation")
                .groupBy("operation").agg(F.count_if(F.col("duration") > F.col("limite")).alias("execucoes_lentas")))
        out = out.join(slow, "operation", "left").withColumn(
            "execucoes_lentas", F.coalesce("execucoes_lentas", F.lit(0).cast("bigint")))
    return out


def recent_ops(log: DataFrame, *, ref: _dt.datetime, hours: float = 24, operations=None,
               keep: int | None = None) -> DataFrame:
    """Operations in the ``hours`` before ``ref`` (inclusive), newest first, ties by id.

    ``operations``: keep names that contain any of these texts, whatever the case.  All operations of
    the window are returned; ``keep`` asks for the newest ``keep`` only."""
    since = ref - _dt.timedelta(hours=hours)
    # wall-clock literals (TIMESTAMP_NTZ), so the window does not move with the session time zone
    lo = F.lit(since.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    hi = F.lit(ref.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    df = log.where((F.col("ts") >= lo) & (F.col("ts") <= hi))
    if operations:
        name = F.lower(F.col("operation"))
        df = df.where(reduce(or_, [name.contains(o.lower()) for o in operations]))
    df = df.orderBy(F.col("ts").desc(), F.col("op_id").desc())
    return df if keep is None else df.limit(keep)


def throughput(log: DataFrame, *, remaining_items: int = 0, mb_field: str = "$.k") -> DataFrame:
    """Per operation: success %, files/s, MB/s, ETA for remaining items and alert flags
    (failure > 20 %, total time > 300 s, < 0.5 files/s).  MB per item from the details JSON."""
    mb = F.get_json_object(F.col("details"), mb_field).cast("double")
    cs = F.round(F.col("duration") * 100).cast("bigint")     # exact centiseconds: order-free sums
    g = log.groupBy("operation").agg(
        F.count(F.lit(1)).alias("itens"), F.count_if("success").alias("ok"),
        (F.sum(cs).cast("double") / 100.0).alias("segundos"), F.sum(mb).alias("mb"))
    fps = F.col("itens") / F.col("segundos")
    return g.select(
        "operation", "itens",
        F.round(F.col("ok") / F.col("itens") * 100.0, 6).alias("pct_sucesso"),
        F.round(fps, 6).alias("arquivos_por_s"),
        F.round(F.col("mb") / F.col("segundos"), 6).alias("mb_por_s"),
        F.round(F.lit(remaining_items) / fps, 6).alias("eta_s"),
        ((1 - F.col("ok") / F.col("itens")) * 100.0 > THROUGHPUT_MAX_FAILURE_PCT).alias("alerta_falhas"),
        (F.col("segundos") > THROUGHPUT_MAX_SECONDS).alias("alerta_tempo"),
        (fps < THROUGHPUT_MIN_FILES_PER_SEC).alias("alerta_vazao"))


def checkpoint_summary(ck: DataFrame) -> DataFrame:
    """Counts by status, by type and overall (GROUPING SETS), newest time per group."""
    g = ck.groupingSets([["status"], ["tipo"], []], "status", "tipo").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("mais_recente"), F.grouping_id().alias("_gid"))
    dim = F.when(F.col("_gid") == 1, "status").when(F.col("_gid") == 2, "tipo").otherwise("total")
    val = F.when(F.col("_gid") == 1, F.col("status")).when(F.col("_gid") == 2, F.col("tipo")).otherwise(F.lit("*"))
    return g.select(dim.alias("dimensao"), val.alias("valor"), "n", "mais_recente")


def checkpoints_filtered(ck: DataFrame, *, status=None, tipo=None, limit: int | None = None) -> DataFrame:
    """E23 (list part): filter by status/type, newest first."""
    if status:
        ck = ck.where(F.col("status").isin(list(status)))
    if tipo:
        ck = ck.where(F.col("tipo").isin(list(tipo)))
    ck = ck.orderBy(F.col("ts").desc(), F.col("id").desc())
    return ck.limit(limit) if limit else ck
