"""Delimited-text ingest.

Text is read with Spark's own readers (``csv``/``text``), which split files
across tasks; every parsing rule is a column expression.  Nothing is read on
the driver except header metadata.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from jobflow.functions.names import canonical_name, dedupe_names
from jobflow.session import scratch_path

CORRUPT = "_linha_corrompida"

# fixed values: separator candidates (profiling) and header candidates (first-line choice)
PROFILE_SEPARATORS = [";", ",", "\t", "|", ":", "#"]
HEADER_SEPARATORS = [";", ",", "\t", "|"]
SALVAGE_PATTERN = "[;,\t]"


def read_delimited(spark: SparkSession, paths, *, sep: str = ";", encoding: str = "utf-8",
                   schema: StructType | str | None = None, header: bool = True,
                   keep_corrupt: bool = False) -> DataFrame:
    """A1/A2: header, separator, encoding; unparseable cells -> null, extra fields dropped.

    With ``keep_corrupt=True`` (and a schema) malformed lines are also kept
    verbatim in the ``_linha_corrompida`` column, so they can be quarantined
    instead of silently nulled.  Large files need no special path: Spark
    splits them by ``spark.sql.files.maxPartitionBytes``.
    """
    r = (spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
         .option("mode", "PERMISSIVE"))
    if schema is not None:
        st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if keep_corrupt:
            st = st.add(CORRUPT, StringType())
            r = r.option("columnNameOfCorruptRecord", CORRUPT)
        r = r.schema(st)
    return r.csv(paths)


def count_fields(line: Column, sep: str) -> Column:
    """Occurrences of ``sep`` in ``line`` (length difference, no regex)."""
    return F.length(line) - F.length(F.replace(line, F.lit(sep), F.lit("")))


def delimiter_of_header(df: DataFrame, line: str = "value") -> Column:
    """Separator with the most occurrences among ; , tab | (ties: list order); null if none."""
    counts = [count_fields(F.col(line), s) for s in HEADER_SEPARATORS]
    best = F.greatest(*counts)
    expr = None
    for s, c in zip(HEADER_SEPARATORS, counts):
        expr = F.when((c == best) & (best > 0), F.lit(s)) if expr is None else expr.when((c == best) & (best > 0), F.lit(s))
    return expr


def header_separator(header: str) -> str:
    """A4: ';' if the header has one, else ',', else tab."""
    return ";" if ";" in header else "," if "," in header else "\t"


def field_count(line: Column, sep: str) -> Column:
    """Fields of a line; separators between quotes do not count (a doubled quote is a quote)."""
    return count_fields(F.regexp_replace(line, '"[^"]*"', ""), sep) + 1


def split_fields(line: Column, names: list[str], sep: str) -> list[Column]:
    """The fields of a line as text columns: quotes removed, missing and empty fields null, extra fields dropped."""
    schema = ", ".join(f"f{i} string" for i in range(len(names)))
    parsed = F.from_csv(line, schema, {"sep": sep, "escape": '"', "mode": "PERMISSIVE"})
    return [parsed[f"f{i}"].alias(n) for i, n in enumerate(names)]


def salvage_lines(spark: SparkSession, path: str, header: str | None = None, *, sep: str | None = None) -> DataFrame:
    """A4: keep only non-empty lines containing ; , or tab (header lines excluded), split by the
    header's separator into the header's columns (missing fields null, extra fields dropped, a separator between
    quotes kept in its field).

    Without ``header`` every file is split by its own first line and the files are stacked by
    column name; one row per distinct header reaches the driver.  No line cap: every line
    of every file is examined, in parallel.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__file"))
    v = F.col("value")

    def split_by(rows: DataFrame, header: str) -> DataFrame:
        by = sep or header_separator(header)
        keep = (F.length(F.trim(v)) > 0) & v.rlike(SALVAGE_PATTERN) & (v != F.lit(header))
        return rows.where(keep).select(*split_fields(v, header.split(by), by))

    if header is not None:
        return split_by(lines, header)
    own = header_lines(spark, path).select(F.col("arquivo").alias("__file"), "cabecalho")
    headers = [r["cabecalho"] for r in own.select("cabecalho").distinct().orderBy("cabecalho").collect()]
    if not headers:
        raise ValueError(f"no lines under {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [split_by(lines.join(own.where(F.col("cabecalho") == h), "__file", "left_semi"), h) for h in headers])


POSITIONAL_FIELDS = ["cnpj", "uf", "municipio", "estabelecimento"]


def parse_positional(df_text: DataFrame, line: str = "value") -> DataFrame:
    """A5: fixed 6-field ';' layout: cnpj;uf;municipio;estabelecimento;admissoes;desligamentos.

    Blank and '#' lines skipped, fewer than 6 fields skipped; a count that is not digits or
    exceeds 64 bits -> 0; saldo only when both counts are numbers, else 0.
    """
    v = F.trim(F.col(line))
    f = F.split(v, ";", -1)
    ok = (F.length(v) > 0) & ~v.startswith("#") & (F.size(f) >= 6)
    a, d = F.trim(F.get(f, 4)), F.trim(F.get(f, 5))
    whole = [F.when(x.rlike(r"^[0-9]+$"), x.try_cast("bigint")) for x in (a, d)]
    none = F.lit(0).cast("bigint")
    return df_text.where(ok).select(
        *[F.trim(F.get(f, i)).alias(n) for i, n in enumerate(POSITIONAL_FIELDS)],
        F.coalesce(whole[0], none).alias("admissoes"), F.coalesce(whole[1], none).alias("desligamentos"),
        F.coalesce(whole[0] - whole[1], none).alias("saldo"))


# fixed values: accepted header spellings of the keyed layout
KEYED_ALIASES = {"cnpj": ["cnpj", "CNPJ"], "uf": ["uf", "UF"], "municipio": ["municipio", "Município"]}
KEYED_NUMERIC = ["admissoes", "desligamentos", "saldo", "saldo_inicial", "saldo_final"]


def _to_int_lenient(c: Column) -> Column:
    """Number with a comma or a dot as decimal mark, truncated toward zero; no number, or one beyond 64 bits -> 0."""
    x = F.regexp_replace(F.trim(c.cast("string")), ",", ".").try_cast("double")
    return F.coalesce(x.try_cast("bigint"), F.lit(0).cast("bigint"))


def keyed_lines(spark: SparkSession, paths, *, sep: str = ";") -> DataFrame:
    """Lines of keyed CSV files, each with ``arquivo``, its file's ``cabecalho`` and whether it is bad: more fields than the header."""
    lines = spark.read.text(paths).select(F.regexp_replace("value", "\r$", "").alias("linha"), F.col("_metadata.file_path").alias("arquivo"))
    heads = header_lines(spark, paths).select("arquivo", "cabecalho")
    return lines.join(heads, "arquivo").where((F.length(F.trim("linha")) > 0) & (F.regexp_replace("linha", "^\ufeff", "") != F.col("cabecalho"))).withColumn(
        "ruim", field_count(F.col("linha"), sep) > field_count(F.col("cabecalho"), sep))


def read_keyed(spark: SparkSession, paths, *, sep: str = ";") -> DataFrame:
    """A6 over files: each file is read by its own header, a separator between quotes stays in its field, lines with too few fields
    are filled with nulls, lines with too many are skipped (``bad_lines`` counts them), and the rows are parsed."""
    lines = keyed_lines(spark, paths, sep=sep).where(~F.col("ruim"))
    headers = [r["cabecalho"] for r in header_lines(spark, paths).select("cabecalho").distinct().orderBy("cabecalho").collect()]
    if not headers:
        raise ValueError(f"no lines under {paths}")
    frames = []
    for h in headers:
        names = dedupe_names([n.strip().strip('"') for n in h.split(sep)])
        frames.append(parse_keyed(lines.where(F.col("cabecalho") == h).select(*split_fields(F.col("linha"), names, sep))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def bad_lines(spark: SparkSession, paths, *, sep: str = ";") -> DataFrame:
    """Lines of each keyed CSV file, and how many of them :func:`read_keyed` skips."""
    return keyed_lines(spark, paths, sep=sep).groupBy("arquivo").agg(
        F.count("*").alias("linhas"), F.count_if("ruim").alias("ruins"))


def parse_keyed(df: DataFrame) -> DataFrame:
    """Keyed CSV rows: first present spelling per field, numbers lenient, failures -> 0."""
    low = set(df.columns)
    cols = []
    for out, cands in KEYED_ALIASES.items():
        present = [c for c in cands if c in low]
        if present:
            cols.append(F.trim(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in present])).alias(out))
    for n in KEYED_NUMERIC:
        if n in low:
            cols.append(_to_int_lenient(F.col(n)).alias(n))
    return df.select(*cols)


def file_profile(spark: SparkSession, paths) -> DataFrame:
    """Per file: bytes, lines, estimated rows (lines - header)."""
    t = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("arquivo"),
                                      F.col("_metadata.file_size").alias("bytes"))
    return (t.groupBy("arquivo").agg(F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("linhas"))
            .withColumn("linhas_estimadas", F.greatest(F.col("linhas") - 1, F.lit(0))))


def delimiter_profile(lines: DataFrame, *, file: str = "arquivo", line: str = "value",
                      candidates=PROFILE_SEPARATORS) -> DataFrame:
    """Per (file, separator) statistics of separator counts per line, score and choice.

    score = mean - 0.3*range - 0.2*std (+0.5*mean when range <= 1 and mean > 2), floored at 0;
    consistency = share of lines with the modal column count.  The chosen
    separator is the first candidate (list order) with consistency >= 0.8 and
    > 2 modal columns; otherwise the best score among candidates with
    consistency >= 0.7 and >= 2 columns.
    """
    # six counts per line first; only they are stacked, not the line
    cand = F.array(*[F.struct(F.lit(i).alias("ordem"), F.lit(s).alias("separador"), count_fields(F.col(line), F.lit(s)).alias("n"))
                     for i, s in enumerate(candidates)])
    x = lines.select(F.col(file).alias("arquivo"), F.inline(cand))
    per_count = x.groupBy("arquivo", "ordem", "separador", "n").agg(F.count(F.lit(1)).alias("k"))
    stats = per_count.groupBy("arquivo", "ordem", "separador").agg(
        (F.sum(F.col("n") * F.col("k")) / F.sum("k")).alias("media"),
        F.min("n").alias("minimo"), F.max("n").alias("maximo"),
        F.sqrt(F.greatest(F.sum(F.col("n") * F.col("n") * F.col("k")) / F.sum("k")
                          - F.pow(F.sum(F.col("n") * F.col("k")) / F.sum("k"), 2), F.lit(0.0))).alias("desvio"),
        F.max(F.struct(F.col("k").alias("k"), (-F.col("n")).alias("neg_n"))).alias("_modal"),
        F.sum("k").alias("linhas"))
    rng = F.col("maximo") - F.col("minimo")
    score = (F.col("media") - 0.3 * rng - 0.2 * F.col("desvio")
             + F.when((rng <= 1) & (F.col("media") > 2), 0.5 * F.col("media")).otherwise(0.0))
    stats = stats.select(
        "arquivo", "ordem", "separador", "linhas", "minimo", "maximo",
        F.round("media", 6).alias("media"), F.round("desvio", 6).alias("desvio"),
        F.round(F.when(F.col("maximo") == 0, 0.0).otherwise(F.greatest(score, F.lit(0.0))), 6).alias("score"),
        (1 - F.col("_modal.neg_n")).alias("colunas_modal"),
        F.round(F.col("_modal.k") / F.col("linhas"), 6).alias("consistencia"))
    structural = (F.col("consistencia") >= 0.8) & (F.col("colunas_modal") > 2)
    valid = (F.col("consistencia") >= 0.7) & (F.col("maximo") + 1 >= 2)
    w = Window.partitionBy("arquivo").orderBy(
        F.when(structural, 0).when(valid & (F.col("score") > 0), 1).otherwise(2), F.when(structural, F.col("ordem")),
        F.col("score").desc(), F.col("ordem"))
    ranked = stats.withColumn("_r", F.row_number().over(w))
    chosen = (F.col("_r") == 1) & (structural | (valid & (F.col("score") > 0)))
    return ranked.withColumn("escolhido", chosen).drop("_r")


def accept_recovered(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """One row: rows >= 2, columns >= 3 and a spelling of >= 2 of the field ``groups`` in the column names."""
    names = " ".join(df.columns).upper()
    found = sum(any(v in names for v in vs) for vs in groups.values())
    n = df.limit(2).agg(F.count(F.lit(1)).alias("linhas_min"))
    return n.select("linhas_min", F.lit(len(df.columns)).alias("colunas"), F.lit(found).alias("grupos"),
                    ((F.col("linhas_min") >= 2) & F.lit(len(df.columns) >= 3) & F.lit(found >= 2)).alias("aceito"))


def text_hashes(df: DataFrame, col: str, *, keep: list[str] = ()) -> DataFrame:
    """E18 over a column: byte length, sha256 and md5 of each value's UTF-8 bytes (null stays null)."""
    return df.select(*keep, F.octet_length(col).cast("bigint").alias("bytes"), F.sha2(F.col(col), 256).alias("sha256"),
                     F.md5(F.col(col)).alias("md5"))


# a file up to this is hashed as one value (an array of at most 2^31 bytes), a larger one in chunks
HASH_LIMIT = 1 << 30
HASH_CHUNK = 1 << 20


def _open(path: str):
    if path.startswith("file:") or "://" not in path:
        return open(path.removeprefix("file:"), "rb")
    from pyarrow import fs
    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_stream(inside)


def _hash_in_chunks(batches):
    for b in batches:
        for path, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            sha, md5, n = hashlib.sha256(), hashlib.md5(usedforsecurity=False), 0
            with _open(path) as f:
                while chunk := f.read(HASH_CHUNK):
                    sha.update(chunk)
                    md5.update(chunk)
                    n += len(chunk)
            if n != size:
                raise OSError(f"{path}: read {n} of {size} bytes")
            yield pa.RecordBatch.from_pydict({"arquivo": [path], "bytes": pa.array([n], pa.int64()),
                                              "sha256": [sha.hexdigest()], "md5": [md5.hexdigest()]})


def file_hashes(spark: SparkSession, paths, limit: int | None = None, whole: int = HASH_LIMIT) -> DataFrame:
    """Per file: size, sha256 and md5 of the bytes, whatever the size.

    Files up to ``whole`` bytes are read by the ``binaryFile`` source.  Larger ones are dealt to tasks by path and read
    there in chunks of 1 MB, from a local path or a store that ``pyarrow.fs`` opens; in any other store they
    raise an error.  Only with a ``limit`` are files above it listed with null hashes and not read.
    """
    b = spark.read.format("binaryFile").load(paths)
    skipped = F.lit(False) if limit is None else F.col("length") > limit
    path, size = F.col("path").alias("arquivo"), F.col("length").alias("bytes")
    small = b.where(~skipped & (F.col("length") <= whole)).select(
        path, size, F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))
    large = b.where(~skipped & (F.col("length") > whole)).select(path, size).repartition(
        spark.sparkContext.defaultParallelism, "arquivo").mapInArrow(
        _hash_in_chunks, "arquivo string, bytes long, sha256 string, md5 string")
    found = small.unionByName(large)
    if limit is None:
        return found
    none = F.lit(None).cast("string")
    return found.unionByName(b.where(skipped).select(path, size, none.alias("sha256"), none.alias("md5")))


def profile_files(spark: SparkSession, paths, candidates=PROFILE_SEPARATORS) -> DataFrame:
    """A22 over landed files: every line of every file, grouped by the file it came from.

    Reads with the ``text`` source (files are split across tasks) and keys each
    line by ``_metadata.file_path``; all lines are profiled, not a sample.
    """
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("arquivo"), "value")
    return delimiter_profile(lines, candidates=candidates)


def _all_utf8(line: str) -> Column:
    """Whether every line of a group is UTF-8, from the set of answers.

    A first line next to it is text, whose sums Spark would build by sorting all lines of a task by file; with a set among them
    it keeps one object per file instead.
    """
    return ~F.array_contains(F.collect_set(F.is_valid_utf8(line)), False)


def header_lines(spark: SparkSession, paths) -> DataFrame:
    """First line of every landed file with its separator (A23 over files) and encoding.

    The first line lives in the split that starts at byte 0 of the file; within
    a split lines keep their order, so the line with the smallest row id of
    that split is the header.  The encoding is UTF-8 if every line of the file is, else ISO-8859-1, so
    the one scan reads whole files, but ships one small aggregate per file and split.
    """
    t = spark.read.option("ignoreCorruptFiles", "true").text(paths).select(
        "value", F.col("_metadata.file_path").alias("arquivo"),
        F.col("_metadata.file_block_start").alias("_inicio"), F.monotonically_increasing_id().alias("_i"))
    first = t.groupBy("arquivo").agg(
        F.min_by("value", F.when(F.col("_inicio") == 0, F.col("_i"))).alias("_bytes"), _all_utf8("value").alias("_utf8"))
    latin = F.decode(F.col("_bytes").cast("binary"), "ISO-8859-1")
    first = first.select("arquivo", F.when(F.is_valid_utf8("_bytes"), F.col("_bytes")).otherwise(latin).alias("value"),
                         F.when(F.col("_utf8"), "UTF-8").otherwise("ISO-8859-1").alias("codificacao"))
    return first.select("arquivo", F.regexp_replace("value", "^\ufeff", "").alias("cabecalho"),
                        delimiter_of_header(first).alias("separador"), "codificacao")


# fixed values: why a landed file is not converted
EMPTY, UNREADABLE, TRUNCATED, NO_SEPARATOR, ONLY_HEADER = "vazio", "ilegivel", "truncado", "separador_desconhecido", "so_cabecalho"
COMPRESSED = r"\.(gz|bz2|deflate|snappy|lz4|zst|zstd|xz)$"
# the size trailer of a gzip file up to this is read with the file as one value
TRAILER_LIMIT = 256 << 20


def plain_path(c: Column | str) -> Column:
    """A path with its scheme written in one way (file:/x and file:///x are the same file)."""
    return F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")


def listed_files(spark: SparkSession, paths) -> DataFrame:
    """Every file under ``paths``: arquivo, _p (its plain path), bytes.  Only the listing is read; a scan alone would leave out files
    without a byte."""
    b = spark.read.format("binaryFile").load(paths)
    names = spark.createDataFrame([(unquote(f),) for f in b.inputFiles()], "arquivo string").withColumn("_p", plain_path("arquivo"))
    sizes = b.select(plain_path("path").alias("_p"), F.col("length").alias("_n"))
    return names.join(sizes, "_p", "left").select("arquivo", "_p", F.coalesce("_n", F.lit(0)).alias("bytes"))


def _reads_whole(spark: SparkSession, files: list[str]) -> set[str]:
    """The files that decode to their end, found by reading them strictly: all at once, and each alone if that fails."""
    def reads(some: list[str]) -> bool:
        try:
            spark.read.option("ignoreCorruptFiles", "false").text(some).agg(F.count("value")).first()
        except (PySparkException, Py4JJavaError):
            return False
        return True

    if not files or reads(files):
        return set(files)
    with ThreadPoolExecutor(8) as pool:  # the jobs run on the cluster; one file each
        return {f for f, whole in zip(files, pool.map(lambda f: reads([f]), files), strict=True) if whole}


def file_status(spark: SparkSession, paths) -> DataFrame:
    """One row per landed file: arquivo, bytes, cabecalho, separador, codificacao, linhas, motivo.

    ``motivo`` is null for a file that can be converted, else why not: empty, unreadable, truncated, no known separator in its
    first line, or only a first line.  One scan of the text gives the first line, the encoding and the bytes decoded.
    A file is whole if these are the bytes expected: its size, or for gzip the size in its trailer.
    Files for which that proves nothing (other codecs, several gzip members, trailers that do not agree) are read
    once more, strictly, and are whole if that reaches their end.  The driver gets the names of those only.
    """
    t = spark.read.option("ignoreCorruptFiles", "true").option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("arquivo"),
        F.col("_metadata.file_block_start").alias("_inicio"), F.monotonically_increasing_id().alias("_i"))
    seen = t.groupBy(plain_path("arquivo").alias("_p")).agg(
        F.min_by("value", F.when(F.col("_inicio") == 0, F.col("_i"))).alias("_b"), _all_utf8("value").alias("_utf8"),
        F.count("*").alias("linhas"), F.sum(F.octet_length("value") + 1).alias("_lidos"))
    files = listed_files(spark, paths)
    last = [F.hex(F.substring("content", -k, 1)) for k in (1, 2, 3, 4)]  # little endian
    trailer = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(paths).where(F.col("length") <= TRAILER_LIMIT).select(
        plain_path("path").alias("_p"), F.conv(F.concat(*last), 16, 10).cast("bigint").alias("_fim"))
    j = files.join(trailer, "_p", "left").join(seen, "_p", "left")
    read, gzip = F.coalesce("_lidos", F.lit(0)), F.lower("arquivo").endswith(".gz")
    expected = F.when(~F.lower("arquivo").rlike(COMPRESSED), F.col("bytes")).when(gzip, F.col("_fim"))
    # the last line may lack its line feed; a gzip trailer counts modulo 2^32
    modulo = lambda n: F.when(gzip, F.pmod(n, F.lit(1 << 32))).otherwise(n)
    proved = F.coalesce((expected == modulo(read)) | (expected == modulo(read - 1)), F.lit(False))
    path = scratch_path(spark, "file-status")
    j = j.select("arquivo", "bytes", "linhas", "_utf8", "_b", proved.alias("_inteiro"))
    j.write.parquet(path)
    j = spark.read.schema(j.schema).parquet(path)
    # a gzip file that gives no line though its trailer says otherwise needs no second look
    unsure = ~F.col("_inteiro") & (F.col("bytes") > 0) & (F.col("linhas").isNotNull() | ~gzip)
    doubtful = [r["arquivo"] for r in j.where(unsure).select("arquivo").collect()]
    whole = sorted(_reads_whole(spark, doubtful))
    first = F.regexp_replace(F.when(F.is_valid_utf8("_b"), F.col("_b")).otherwise(F.decode(F.col("_b").cast("binary"), "ISO-8859-1")),
                             "^\ufeff|\r.*$", "")
    j = j.withColumn("_inteiro", F.col("_inteiro") | F.col("arquivo").isin(whole)).withColumn("cabecalho", first)
    sep = delimiter_of_header(j, "cabecalho")
    why = (F.when((F.col("bytes") == 0) | (F.col("_inteiro") & F.col("linhas").isNull()), EMPTY)
           .when(~F.col("_inteiro"), F.when(F.col("linhas").isNull(), UNREADABLE).otherwise(TRUNCATED))
           .when(sep.isNull(), NO_SEPARATOR).when(F.col("linhas") < 2, ONLY_HEADER))
    return j.select("arquivo", "bytes", "cabecalho", sep.alias("separador"),
                    F.when(F.col("_utf8"), "UTF-8").otherwise("ISO-8859-1").alias("codificacao"),
                    F.coalesce("linhas", F.lit(0)).alias("linhas"), why.alias("motivo"))


def read_grouped(spark: SparkSession, paths, status: DataFrame | None = None) -> DataFrame:
    """Landed files whose headers, separators and encodings differ, stacked by canonical column name.

    Files are grouped by (header, separator, encoding), each group is read with its own names, so the
    order of columns may differ from file to file.  All columns are text; ``_arquivo`` names
    the file and ``_linha_corrompida`` holds a line with too few or too many fields verbatim.  Files for which ``status``
    (``file_status``) has a reason are left out, whole.  The driver gets one row per distinct header with its file names.
    """
    heads = (file_status(spark, paths) if status is None else status).where(f"motivo IS NULL OR motivo = '{ONLY_HEADER}'")
    groups = (heads.groupBy("cabecalho", "separador", "codificacao").agg(F.sort_array(F.collect_list("arquivo")).alias("arquivos"))
              .orderBy("cabecalho", "codificacao").collect())
    frames = []
    for g in groups:
        names = dedupe_names([canonical_name(c.strip().strip('"')) for c in g["cabecalho"].split(g["separador"])])
        schema = StructType([StructField(n, StringType()) for n in [*names, CORRUPT]])
        df = (spark.read.option("header", True).option("sep", g["separador"]).option("encoding", g["codificacao"])
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("escape", '"').schema(schema).csv(g["arquivos"]))
        # fields are only counted where all columns are read, so the malformed line asks for all of them
        whole = F.length(F.concat_ws("", *names)) >= 0
        frames.append(df.select(*names, F.when(whole, F.col(CORRUPT)).alias(CORRUPT), F.col("_metadata.file_path").alias("_arquivo")))
    if not frames:
        return spark.createDataFrame([], StructType([StructField(CORRUPT, StringType()), StructField("_arquivo", StringType())]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
