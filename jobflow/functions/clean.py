"""Value cleaning and parsing as column expressions (B1 values, B12, B13, B17, A3).

All are built-in Spark expressions (regexp_replace, translate, try_cast,
try_to_date), so they stay inside whole-stage codegen; no Python UDF.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters -> base letter, generated by Unicode decomposition (U+00C0-U+024F)."""
    src, dst = [], []
    for cp in range(0x00C0, 0x0250):
        ch = chr(cp)
        base = unicodedata.normalize("NFD", ch)[0]
        if base != ch and base.isascii() and base.isalpha():
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


ACCENTED, UNACCENTED = _accent_table()


def strip_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, UNACCENTED)


def normalize_text(c: Column, empty: str = "COLUNA_SEM_NOME") -> Column:
    """B1 on values: strip accents, non-alphanumerics -> space, collapse, upper, spaces -> '_'.

    Every maximal run of characters outside [a-zA-Z0-9] ends up as one '_', so
    the rule is one regex pass plus a trim of '_' at both ends.  Upper-casing
    runs last, on pure ASCII, so it is locale-free ('ß' stays a separator).
    The empty result becomes the placeholder through an anchored replace, so
    the normalised value is referenced (and computed) once; null stays null.
    """
    s = F.upper(F.btrim(F.regexp_replace(strip_accents(c), r"[^a-zA-Z0-9]+", "_"), F.lit("_")))
    return F.regexp_replace(s, r"^$", empty)


def clean_int(c: Column) -> Column:
    """Keep digits and '-', only signs/empty/zeros -> 0, unparseable or null -> 0."""
    s = F.regexp_replace(c.cast("string"), r"[^0-9-]", "")
    s = F.when(s.rlike(r"^-*$") | s.rlike(r"^0+$"), F.lit("0")).otherwise(s)
    return F.coalesce(s.try_cast("bigint"), F.lit(0).cast("bigint"))


def clean_float(c: Column) -> Column:
    """Keep digits . , - ; with a comma present, dots are thousands separators
    and the comma is the decimal mark; empty, unparseable or null -> 0.0."""
    s = F.regexp_replace(c.cast("string"), r"[^0-9.,-]", "")
    s = F.when(s.contains(","), F.regexp_replace(F.regexp_replace(s, r"\.", ""), ",", ".")).otherwise(s)
    s = F.when(s == "", F.lit("0")).otherwise(s)
    return F.coalesce(s.try_cast("double"), F.lit(0.0))


def clean_text(c: Column) -> Column:
    """Trim, null -> ''."""
    return F.coalesce(F.trim(c.cast("string")), F.lit(""))


# fixed values: accepted boolean spellings
TRUE_WORDS = ["true", "1", "sim", "s", "yes", "y"]
FALSE_WORDS = ["false", "0", "nao", "n", "no"]


def clean_bool(c: Column) -> Column:
    """B12d: true for the true spellings; false for the false ones, anything else, and null."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(TRUE_WORDS), F.lit(False))


def norm_period(c: Column) -> Column:
    """B13: 'YYYYMM' -> 'YYYY-MM' (by length 6); other values unchanged."""
    return F.when(F.length(c) == 6, F.concat(F.substring(c, 1, 4), F.lit("-"), F.substring(c, 5, 2))).otherwise(c)


# fixed values: date formats tried in order
DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd", "dd-MM-yyyy", "yyyy/MM/dd"]


def parse_date_any(c: Column) -> Column:
    """First format that parses wins; none -> null."""
    return F.coalesce(*[F.try_to_date(c, f)
                        for f in DATE_FORMATS])


NULL_LITERALS = ["", "NULL", "null", "NA", "N/A", "#N/A"]


def null_literals(df: DataFrame, literals=NULL_LITERALS, cols: list[str] | None = None) -> DataFrame:
    """A3: string cells equal to a null literal become null (every string column by default)."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.when(F.col(c).isin(list(literals)), F.lit(None)).otherwise(F.col(c)) for c in cols})


def apply_schema(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Caller-given type overrides via try_cast; columns absent from df are ignored."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def any_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds)


INT_PATTERN = r"^-?\d+$"
FLOAT_PATTERN = r"^-?\d+(\.\d+)?$"
# fixed values: words of a column name that suggest a whole number or a decimal one
INT_WORDS = ["ADMITIDO", "ADMITIDOS", "DESLIGADO", "DESLIGADOS", "SALDO", "QUANTIDADE", "TOTAL", "VALOR", "COUNT", "ADMIT", "DESLIG",
             "QTD", "NUM", "ANO", "MES", "IDADE"]
FLOAT_WORDS = ["SALARIO", "REMUNERACAO", "PERCENTUAL", "TAXA", "INDICE", "MEDIA", "VARIACAO", "PROPORCAO"]


def suggested_type(name: str) -> str:
    """Int, float or text by the words of a column name (whole words, whole numbers first)."""
    words = set(name.upper().split("_"))
    return "int" if words & set(INT_WORDS) else "float" if words & set(FLOAT_WORDS) else "text"


def infer_types(df: DataFrame, cols: list[str], *, by_name: bool = False) -> DataFrame:
    """Per text column, the narrowest of int / float / text that fits every non-null value.

    One aggregate over the whole column (not a sample): counts of values that
    are not integers (of 64 bits) and not decimals, then the demotion int -> float -> text.  ``by_name`` starts
    from the type that the column's name suggests, and a column of nulls only is text.
    """
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("string")
        whole = v.rlike(INT_PATTERN) & v.try_cast("bigint").isNotNull()
        aggs += [F.count_if(v.isNotNull() & ~whole).alias(f"ni{i}"),
                 F.count_if(v.isNotNull() & ~v.rlike(FLOAT_PATTERN)).alias(f"nf{i}"), F.count(v).alias(f"n{i}")]
    rows = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(f"ni{i}").alias("n_nao_int"), F.col(f"nf{i}").alias("n_nao_float"),
                              F.lit(suggested_type(c) if by_name else "int").alias("__s"), F.col(f"n{i}").alias("__n"))
                     for i, c in enumerate(cols)])
    out = df.agg(*aggs).select(F.inline(rows))
    empty = (F.col("__n") == 0) & F.lit(by_name)
    kind = (F.when((F.col("__s") == "text") | empty, "text").when((F.col("__s") == "int") & (F.col("n_nao_int") == 0), "int")
            .when(F.col("n_nao_float") == 0, "float").otherwise("text"))
    return out.withColumn("tipo_inferido", kind).drop("__s", "__n")


def pick(df: DataFrame, candidates: list[str]) -> Column:
    """First present column among candidate spellings (case-insensitive), else null."""
    low = {c.lower(): c for c in df.columns}
    for cand in candidates:
        if cand.lower() in low:
            return F.col(f"`{low[cand.lower()]}`")
    return F.lit(None)
