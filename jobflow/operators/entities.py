"""Typed entity projections (B16, B20, B21): movement, exclusion, late declaration, balance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobflow.functions.clean import norm_period, pick
from jobflow.functions.codes import ADMISSION_ALIASES, SEPARATION_ALIASES, ADMISSION, direction
from jobflow.session import scratch_path

ADMISSAO, DESLIGAMENTO = "admissao", "desligamento"


def to_movements(df: DataFrame, *, code_candidates=("tipo_movimentacao", "tipo", "movimentacao"),
                 admitted="admitidos", separated="desligados") -> DataFrame:
    """Movement records (id, cnpj, cpf, competencia 'YYYY-MM', tipo_movimentacao, data_movimentacao).

    Type from the code ('1' / '2' / text aliases), else from the sign of the
    admitted/separated counts, else admission.  An id that is no number is null, such a count is 0.
    """
    code = F.upper(F.trim(pick(df, list(code_candidates)).cast("string")))
    a = F.coalesce(pick(df, [admitted]).try_cast("bigint"), F.lit(0))
    d = F.coalesce(pick(df, [separated]).try_cast("bigint"), F.lit(0))
    tipo = (F.when(code.isin(["1"] + ADMISSION_ALIASES), ADMISSAO)
            .when(code.isin(["2"] + SEPARATION_ALIASES), DESLIGAMENTO)
            .when(a > 0, ADMISSAO).when(d > 0, DESLIGAMENTO).otherwise(ADMISSAO))
    return df.select(
        pick(df, ["id"]).try_cast("bigint").alias("id"),
        pick(df, ["cnpj", "cnpj_raiz"]).cast("string").alias("cnpj"),
        pick(df, ["cpf"]).cast("string").alias("cpf"),
        norm_period(pick(df, ["competencia_mov", "competencia"]).cast("string")).alias("competencia"),
        tipo.alias("tipo_movimentacao"),
        F.lit(None).cast("date").alias("data_movimentacao"))


def to_entities(df: DataFrame, *, tipo="tipo", code="tipo_movimentacao") -> DataFrame:
    """One entity shape per file type, built in ONE projection (no split and re-union).

    MOV -> movement (detail = admissao/desligamento), EXC -> exclusion
    (detail = excluded type), FOR -> late declaration (detail = original
    competência, date = first day of the declared month); other types dropped.  An id that is
    no number and a declared month that is no month become null.
    """
    t = F.col(tipo)
    d = direction(F.col(code))
    comp = norm_period(F.col("competencia_mov"))
    return df.where(t.isin("MOV", "EXC", "FOR")).select(
        F.col("id").try_cast("bigint").alias("id"), F.col("cnpj").cast("string").alias("cnpj"),
        F.col("cpf").cast("string").alias("cpf"), comp.alias("competencia"),
        F.when(t == "MOV", "movimentacao").when(t == "EXC", "exclusao").otherwise("fora_prazo").alias("tipo_entidade"),
        F.when(t == "MOV", F.when(d == ADMISSION, ADMISSAO).when(d.isNotNull(), DESLIGAMENTO))
        .when(t == "EXC", F.col(code).cast("string")).otherwise(comp).alias("detalhe"),
        F.when(t == "FOR", F.try_to_date(F.concat(F.col("competencia_dec"), F.lit("01")), "yyyyMMdd")).alias("data"))


def with_surrogate_id(df: DataFrame, order: list[str], *, out: str = "id") -> DataFrame:
    """B21 for small results: 1-based counter over a stable order.

    A global row_number moves every row into one partition, so use it only
    on small outputs (series, reports).  For fact tables use
    :func:`with_dense_id`, or :func:`with_hash_id` where ids need not be dense.
    """
    return df.withColumn(out, F.row_number().over(Window.orderBy(*order)))


def with_dense_id(df: DataFrame, order: list[str], *, out: str = "id") -> DataFrame:
    """B21 for facts: ids 1..n without gaps or repeats, in the order of ``order`` and then of the other columns.

    Two passes: the rows are range-partitioned and sorted (from a sample; the other columns split a value that very many rows
    share) and stored with their place in the task; then one small row per task gives the offset of its first id.  No
    task holds more than its range.  Rows that are equal in all columns get ids in either order.
    """
    spark = df.sparkSession
    keys = [*order, *[c for c in df.columns if c not in order and c != out]]
    path = scratch_path(spark, "dense-id")
    (df.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
     .withColumn("__pos", F.monotonically_increasing_id()).write.parquet(path))
    placed = spark.read.parquet(path).withColumn("__task", F.shiftright("__pos", 33))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    runs = placed.groupBy("__task").agg(F.min("__pos").alias("__first"), F.count("*").alias("__n")).select(
        "__task", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    rest = [c for c in df.columns if c != out]
    return placed.join(runs, "__task").select((F.col("__pos") + F.col("__shift")).cast("bigint").alias(out), *rest)


def with_hash_id(df: DataFrame, key: list[str], *, out: str = "id") -> DataFrame:
    """B21 for facts: deterministic 64-bit id from the key columns (no shuffle); two keys may share one."""
    return df.withColumn(out, F.xxhash64(*[F.col(k) for k in key]))


def balance_entities(df: DataFrame, *, company="cnpj", month="competencia_mov", tipo="tipo",
                     code="tipo_movimentacao", saldo="saldo_movimentacao") -> DataFrame:
    """B20 (balance type): per (company, month) admissions, separations, balance and the
    exclusions of admissions / separations - computed, not left at 0.

    Regular rows (MOV, FOR) count as admissions/separations by direction;
    exclusion rows count in ``exc_*`` and net out of the balance.
    """
    d = direction(F.col(code))
    t = F.col(tipo)
    regular = t != "EXC"
    adm = F.count_if(regular & (d == ADMISSION))
    des = F.count_if(regular & (d == "D"))
    exc_a = F.count_if(~regular & (d == ADMISSION))
    exc_d = F.count_if(~regular & (d == "D"))
    return (df.where(F.length(F.trim(F.col(company).cast("string"))) > 0)
            .groupBy(F.col(company).cast("string").alias("cnpj"), norm_period(F.col(month).cast("string")).alias("competencia"))
            .agg(adm.alias("admissoes"), des.alias("desligamentos"), exc_a.alias("exc_admissoes"),
                 exc_d.alias("exc_desligamentos"))
            .withColumn("saldo", F.col("admissoes") - F.col("desligamentos") - F.col("exc_admissoes")
                        + F.col("exc_desligamentos")))
