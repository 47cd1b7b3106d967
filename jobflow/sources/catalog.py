"""Landed-file catalogue (A19-A21, M2 helpers): metadata from file names, filters and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobflow.functions.codes import UF_LETTERS

NAME_PATTERN = r"(MOV|EXC|FOR)(\d{4})(\d{2})"


def parse_file_name(name: Column) -> Column:
    """struct(tipo, ano, mes, competencia, extensao, modalidade) from a file name.

    Type comes from the name prefix rule (MOV / EXC / FOR; anything else 'outros').
    """
    t = F.regexp_extract(name, NAME_PATTERN, 1)
    y = F.regexp_extract(name, NAME_PATTERN, 2)
    m = F.regexp_extract(name, NAME_PATTERN, 3)
    ext = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    return F.struct(
        F.when(t != "", t).otherwise(F.lit("outros")).alias("tipo"),
        F.when(y != "", y.cast("int")).alias("ano"),
        F.when(m != "", m.cast("int")).alias("mes"),
        F.when(y != "", F.concat(y, m)).alias("competencia"),
        ext.alias("extensao"),
        F.when(ext.isin("7z", "zip"), "compactado").when(ext.isin("txt", "csv"), "texto")
        .when(ext == "parquet", "parquet").otherwise("outro").alias("modalidade"))


# fixed values: spellings of the file types in names, in the order in which they are tried
TYPE_WORDS = {"MOV": ["MOVIMENTACAO", "MOVIMENTAÇÃO", "MOVIMENT", "MOV"], "EXC": ["EXCLUSAO", "EXCLUSÃO", "EXCL", "EXC"],
              "FOR": ["FORA_PRAZO", "FORA PRAZO", "FORAPRAZO", "FOR", "FP"]}


def match_keys(name: Column) -> Column:
    """D3: struct(base, ano, mes, uf, tipo) that a file name gives for matching; parts that it does not state are null.

    The year is the first 20YY, the month the two digits after it if they are 01 to 12, the state two letters that no other
    letter touches, the type the first of the equivalent spellings (MOV, EXC, FOR; 'outros' if none).
    """
    plain = F.element_at(F.split(name, "/"), -1)
    base = F.regexp_replace(plain, r"\.[A-Za-z0-9]+$", "")
    up = F.upper(base)
    year, month = F.regexp_extract(up, r"(20\d{2})", 1), F.regexp_extract(up, r"20\d{2}(0[1-9]|1[0-2])", 1)
    uf = F.regexp_extract(up, "(?<![A-Z])(" + "|".join(UF_LETTERS.values()) + ")(?![A-Z])", 1)
    kind = F.lit("outros")
    for tipo in reversed(TYPE_WORDS):
        kind = F.when(up.rlike("(?<![A-Z])(" + "|".join(TYPE_WORDS[tipo]) + ")(?![A-Z])"), tipo).otherwise(kind)
    return F.struct(up.alias("base"), F.nullif(year, F.lit("")).alias("ano"), F.nullif(month, F.lit("")).alias("mes"),
                    F.nullif(uf, F.lit("")).alias("uf"), kind.alias("tipo"))


def with_file_meta(cat: DataFrame, name: str = "file_name") -> DataFrame:
    return cat.withColumn("_meta", parse_file_name(F.col(name))).select("*", "_meta.*").drop("_meta")


def filter_catalog(cat: DataFrame, *, year: int | None = None, years: tuple[int, int] | None = None,
                   ufs=None, tipos=None) -> DataFrame:
    """Filter by year, inclusive year range, UF list, type list (catalogue with metadata)."""
    if year is not None:
        cat = cat.where(F.col("ano") == year)
    if years is not None:
        cat = cat.where(F.col("ano").between(years[0], years[1]))
    if ufs:
        cat = cat.where(F.col("uf").isin(list(ufs)))
    if tipos:
        cat = cat.where(F.col("tipo").isin(list(tipos)))
    return cat


def catalog_report(cat: DataFrame) -> DataFrame:
    """Counts by extension, type, competência, UF and year plus the overall total; size
    stats; processed counts.  One GROUPING SETS aggregate (one scan, one shuffle); the
    ``dimensao`` column names the grouping."""
    dims = ["extensao", "tipo", "competencia", "uf", "ano"]
    base = cat.select("extensao", "tipo", "competencia", F.col("uf").cast("string").alias("uf"),
                      F.col("ano").cast("string").alias("ano"), "size_bytes", "processed")
    g = base.groupingSets([[d] for d in dims] + [[]], *dims).agg(
        F.count(F.lit(1)).alias("arquivos"), F.sum("size_bytes").alias("bytes_total"),
        F.round(F.avg("size_bytes"), 6).alias("bytes_medio"), F.min("size_bytes").alias("bytes_min"),
        F.max("size_bytes").alias("bytes_max"), F.count_if("processed").alias("processados"),
        F.grouping_id().alias("_gid"))
    full = (1 << len(dims)) - 1
    dim, val = F.when(F.col("_gid") == full, F.lit("total")), F.when(F.col("_gid") == full, F.lit("*"))
    for i, d in enumerate(dims):
        gid = full ^ (1 << (len(dims) - 1 - i))
        dim, val = dim.when(F.col("_gid") == gid, F.lit(d)), val.when(F.col("_gid") == gid, F.col(d))
    return g.select(dim.alias("dimensao"), val.alias("valor"), "arquivos", "bytes_total", "bytes_medio",
                    "bytes_min", "bytes_max", "processados")


def catalog_distincts(cat: DataFrame) -> DataFrame:
    """A21 (distinct part): distinct years, UFs, types and months in the catalogue."""
    return cat.agg(F.count_distinct("ano").alias("anos"), F.count_distinct("uf").alias("ufs"),
                   F.count_distinct("tipo").alias("tipos"), F.count_distinct("competencia").alias("competencias"))


def success_rate_by_month(cat: DataFrame, *, ok: str = "processed") -> DataFrame:
    """% of files successfully processed per calendar month."""
    return cat.groupBy("mes").agg(F.round(F.avg(F.when(F.col(ok), 100.0).otherwise(0.0)), 6).alias("taxa_sucesso"),
                                  F.count(F.lit(1)).alias("arquivos"))


def catalog_from_files(spark, root: str, *, glob: str = "*", recursive: bool = True) -> DataFrame:
    """File catalogue of landed files: name, size, modification time, plus A19 metadata.

    Uses the ``binaryFile`` source's metadata columns only; the ``content``
    column is never selected, so no file bytes are read.
    """
    b = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
         .option("recursiveFileLookup", str(recursive).lower()).load(root))
    cat = b.select(F.col("path"), F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                   F.col("length").alias("size_bytes"), F.col("modificationTime").alias("mtime"))
    return with_file_meta(cat)
