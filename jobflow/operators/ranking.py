"""Sorts, limits and top-k (G3-G7).  Every limit has a total order, so it is deterministic.

``orderBy(...).limit(k)`` is planned as TakeOrderedAndProject: each partition
keeps its own top k and only k x #partitions rows reach the final merge, so
no global sort of the input happens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def head_tail(bal: DataFrame, k: int = 5, *, month: str = "competencia") -> DataFrame:
    """First k and last k months, tagged 'inicio' / 'fim' (a month in both appears twice).

    Two row numbers over the small series and one explode, so the series is
    computed once (two ordered limits would evaluate it twice).
    """
    cols = bal.columns
    ranked = (bal.withColumn("__up", F.row_number().over(Window.orderBy(F.col(month).asc())))
              .withColumn("__down", F.row_number().over(Window.orderBy(F.col(month).desc()))))
    tags = F.array_compact(F.array(F.when(F.col("__up") <= k, F.lit("inicio")),
                                   F.when(F.col("__down") <= k, F.lit("fim"))))
    return ranked.select(*cols, F.explode(tags).alias("posicao"))


def examples(df: DataFrame, predicate: Column, k: int = 3, order: list[str] | None = None) -> DataFrame:
    """The first k offending rows (ordered by ``order``, default all columns)."""
    return df.where(predicate).orderBy(*(order or df.columns)).limit(k)


def largest(cat: DataFrame, k: int = 10, *, size: str = "size_bytes", name: str = "file_name") -> DataFrame:
    """K largest files, ties by name."""
    return cat.orderBy(F.col(size).desc(), F.col(name).asc()).limit(k)


def topk_per_group(df: DataFrame, group: list[str], key: str, k: int, *, tie: list[str] | None = None,
                   out: str = "rank") -> DataFrame:
    """Top k rows per group by ``key`` descending, ties by ``tie`` ascending.

    Meant for aggregated inputs (one row per group member); the window sorts
    each group's members, not fact rows.
    """
    w = Window.partitionBy(*group).orderBy(F.col(key).desc(), *[F.col(t).asc() for t in (tie or [])])
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


def slowest(log: DataFrame, k: int, *, since: str, until: str, ts: str = "ts", duration: str = "duration",
            op_id: str = "op_id") -> DataFrame:
    """The k slowest operations of the window ``since`` <= time <= ``until`` (wall-clock texts), ties by id."""
    at = F.col(ts)
    window = (at >= F.lit(since).cast("timestamp_ntz")) & (at <= F.lit(until).cast("timestamp_ntz"))
    return log.where(window).orderBy(F.col(duration).desc(), F.col(op_id).asc()).limit(k)
