"""Layouts whose months differ, versioned datasets, the incremental balance job, and files that cannot be converted."""

import gzip
import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobflow.operators import joins as D
from jobflow.operators.entities import balance_entities, to_entities, to_movements, with_dense_id  # noqa: F401
from jobflow.plans import jobs as J
from jobflow.session import scratch_path
from jobflow.sources import files as FL
from jobflow.sources import text as TX
from jobflow.sources import versions as VS


def months(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


# --- columns that change ------------------------------------------------------------------------------

def test_every_column_of_every_month_is_read(spark):
    root = scratch_path(spark, "t-drift")
    FL.write_monthly(months(spark, [(1, "202101", 5)], "id int, competencia_mov string, uf int"), root)
    FL.write_monthly(months(spark, [(2, "202102", 1.5)], "id int, competencia_mov string, Salario double"), root)
    FL.write_monthly(months(spark, [(3, "202103", 7)], "id bigint, competencia_mov string, salario int"), root)
    FL.write_monthly(months(spark, [(4, "202104", "SP")], "id int, competencia_mov string, uf string"), root)
    df = FL.read_period(spark, root)
    assert {f.name.lower(): f.dataType for f in df.schema.fields} | {"ano": T.IntegerType(), "mes": T.IntegerType()} == {
        "id": T.LongType(), "competencia_mov": T.StringType(), "uf": T.StringType(), "salario": T.DoubleType(),
        "tipo": T.StringType(), "ano": T.IntegerType(), "mes": T.IntegerType()}
    got = {r["id"]: (r["uf"], r["salario"], r["mes"]) for r in df.toDF(*[c.lower() for c in df.columns]).collect()}
    assert df.columns[-3:] == FL.PARTITIONS and got == {1: ("5", None, 1), 2: (None, 1.5, 2), 3: (None, 7.0, 3), 4: ("SP", None, 4)}
    two = FL.read_period(spark, root, [(2021, 1), (2021, 2)])       # these two do not conflict
    assert {r["id"]: (r["uf"], r["salario"]) for r in two.select("id", "uf", F.col("salario").alias("salario")).collect()} == {1: (5, None), 2: (None, 1.5)}
    out = FL.consolidate(spark, root, [2021], scratch_path(spark, "t-drift-out"))
    back = spark.read.parquet(out)
    assert back.count() == 4 and {c.lower() for c in back.columns} >= {"uf", "salario"}


def test_only_the_months_asked_for_are_scanned(spark):
    root = scratch_path(spark, "t-prune")
    FL.write_monthly(months(spark, [(k, f"2021{k:02d}") for k in range(1, 13)], "id int, competencia_mov string"), root)
    df = FL.read_period(spark, root, [(2021, 3), (2021, 11)], "MOV")
    assert sorted({f.split("/mes=")[1].split("/")[0] for f in df.inputFiles()}) == ["11", "3"]
    none = FL.read_period(spark, root, [(2030, 1)])
    assert none.count() == 0 and none.columns == ["id", "competencia_mov", "tipo", "ano", "mes"]


def test_a_rewritten_month_takes_its_new_columns(spark):
    root = scratch_path(spark, "t-rewrite")
    FL.write_monthly(months(spark, [(1, "202101", "a"), (2, "202102", "b")], "id int, competencia_mov string, x string"), root)
    FL.write_monthly(months(spark, [(3, "202101", 9)], "id int, competencia_mov string, y int"), root)
    got = {r["id"]: (r["x"], r["y"]) for r in FL.read_period(spark, root).collect()}
    assert got == {3: (None, 9), 2: ("b", None)}


def test_common_types():
    i, b, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert FL.common_type(i, b) == b and FL.common_type(b, d) == d and FL.common_type(T.DecimalType(10, 2), i) == d
    assert FL.common_type(i, s) == s and FL.common_type(T.NullType(), i) == i and FL.common_type(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert FL.common_type(T.BooleanType(), i) == s


# --- consolidation order (G2) -----------------------------------------------------------------------------

def test_consolidated_rows_are_sorted_by_the_first_date_column(spark):
    root = scratch_path(spark, "t-sorted")
    rows = [(k, f"2021{k % 12 + 1:02d}", f"2021-{k % 12 + 1:02d}-{k % 28 + 1:02d}") for k in range(500)]
    FL.write_monthly(months(spark, rows, "id int, competencia_mov string, data_movimentacao string"), root)
    out = FL.consolidate(spark, root, [2021], scratch_path(spark, "t-sorted-out"))
    files = sorted(f for f in os.listdir(out) if f.endswith(".parquet"))
    got = [r[0] for f in files for r in spark.read.parquet(os.path.join(out, f)).select("data_movimentacao").collect()]
    assert got == sorted(r[2] for r in rows)  # within a file and from file to file


# --- versions ---------------------------------------------------------------------------------------------

def test_a_reader_keeps_its_version_while_others_are_published(spark):
    root = scratch_path(spark, "t-versions")
    with pytest.raises(FileNotFoundError):
        VS.read(spark, root, "x")
    assert VS.publish(spark, root, {"x": spark.range(3)}) == 0
    seen = VS.read(spark, root, "x")
    assert VS.publish(spark, root, {"x": seen.union(seen)}) == 1        # computed from the version it replaces
    assert seen.count() == 3 and VS.read(spark, root, "x").count() == 6
    # a writer that has not moved the pointer is invisible
    spark.range(99).write.parquet(f"{root}/dados-unfinished/x")
    assert VS.read(spark, root, "x").count() == 6 and VS.current(spark, root) == 1


def test_publishing_a_version_again_changes_nothing(spark):
    root = scratch_path(spark, "t-replay")
    VS.publish(spark, root, {"x": spark.range(3)}, version=7)
    VS.publish(spark, root, {"x": spark.range(5)}, version=7)
    assert VS.read(spark, root, "x").count() == 3 and VS.publish(spark, root, {"x": spark.range(1)}) == 8


def test_old_versions_and_orphans_are_removed(spark):
    root = scratch_path(spark, "t-expire")
    for n in range(5):
        VS.publish(spark, root, {"x": spark.range(n)}, keep=2)
    assert list(VS.versions(spark, root)) == [3, 4]
    assert len([d for d in os.listdir(root) if d.startswith("dados-")]) == 2
    spark.range(1).write.parquet(f"{root}/dados-orphan/x")
    VS.expire(spark, root, keep=2)
    assert "dados-orphan" in os.listdir(root)                            # a writer may still be at it
    VS.expire(spark, root, keep=2, orphan_seconds=-60)
    assert "dados-orphan" not in os.listdir(root) and VS.read(spark, root, "x").count() == 4


def test_a_lost_update_is_an_error(spark):
    root = scratch_path(spark, "t-stale")
    VS.publish(spark, root, {"x": spark.range(1)}, expected=-1)
    with pytest.raises(VS.StaleVersionError):
        VS.publish(spark, root, {"x": spark.range(2)}, expected=-1)
    assert VS.read(spark, root, "x").count() == 1


def test_readers_see_whole_versions_during_writes(spark):
    root = scratch_path(spark, "t-concurrent")
    VS.publish(spark, root, {"a": spark.range(10), "b": spark.range(10)})
    stop, bad = threading.Event(), []

    def reader():
        while not stop.is_set():
            v = VS.current(spark, root)
            a, b = (VS.read(spark, root, t, v).count() for t in "ab")
            if a != b:
                bad.append((v, a, b))
    t = threading.Thread(target=reader)
    t.start()
    for n in range(11, 16):
        VS.publish(spark, root, {"a": spark.range(n), "b": spark.range(n)}, keep=50)
    stop.set()
    t.join()
    assert not bad


# --- incremental balance ------------------------------------------------------------------------------------

MOVS = "id int, competencia_mov string, tipo string, tipo_movimentacao string, saldo_movimentacao int"


def test_balance_job_reads_only_new_and_rewritten_months(spark, monkeypatch):
    root, store = scratch_path(spark, "t-n3"), scratch_path(spark, "t-n3-store")
    asked = []
    own = FL.read_period
    monkeypatch.setattr(FL, "read_period", lambda s, r, p=None, t=None: asked.append(p) or own(s, r, p, t))
    rows = [(1, "202001", "MOV", "10", 1), (2, "202002", "MOV", "31", -1), (3, "202002", "FOR", "20", 1)]
    FL.write_monthly(months(spark, rows, MOVS), root)
    first = J.balance_job(spark, root, store)
    assert [tuple(r) for r in first.orderBy("competencia").collect()] == [
        ("202001", 1, 0, 1, 39054508), ("202002", 1, 1, 0, 39054508)]
    assert asked == [[(2020, 1), (2020, 2)]] * 3
    asked.clear()
    assert J.balance_job(spark, root, store).count() == 2 and not asked and VS.current(spark, store) == 0
    FL.write_monthly(months(spark, [(4, "202003", "MOV", "10", 1)], MOVS), root)
    FL.write_monthly(months(spark, [(5, "202001", "EXC", "10", 1)], MOVS), root)  # a late exclusion reaches an old month
    got = J.balance_job(spark, root, store)
    assert asked == [[(2020, 1), (2020, 3)]] * 3
    full = J.balance_from_layout(spark, root)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect())) and VS.current(spark, store) == 1
    asked.clear()
    gone = os.path.join(root.removeprefix("file:"), "tipo=MOV/ano=2020/mes=3")
    for f in os.listdir(gone):
        os.remove(os.path.join(gone, f))
    os.rmdir(gone)
    assert J.balance_job(spark, root, store).count() == 2 and asked[0] == [(2020, 3)]   # a month that is gone leaves the series


# --- files that cannot be converted ----------------------------------------------------------------------

HEAD = "competência;uf;saldomovimentação\n"


@pytest.fixture(scope="module")
def landed(spark):
    root = scratch_path(spark, "t-landed").removeprefix("file:")
    os.makedirs(root)

    def put(name, data):
        with open(os.path.join(root, name), "wb") as f:
            f.write(data)
    lines = HEAD + "".join(f"202101;{35 + k % 3};{k}\n" for k in range(20000))
    whole = gzip.compress(lines.encode())
    put("bom.csv", lines[:-1].encode())                                  # no line feed at the end
    put("bom.csv.gz", whole)
    put("membros.csv.gz", gzip.compress(lines[:len(HEAD) + 1].encode()) + gzip.compress(lines[len(HEAD) + 1:].encode()))
    put("latim.txt", lines.replace("\n", "\r\n").encode("latin-1"))
    put("cortado.csv.gz", whole[:len(whole) // 2])
    put("texto.csv.gz", b"isto nao e gzip\n")
    put("outro.csv", lines.replace(";", ":").encode())
    put("titulo.csv", HEAD.encode())
    put("vazio.csv", b"")
    put("vazio.csv.gz", gzip.compress(b""))
    return root


def test_every_file_has_rows_or_a_reason(spark, landed):
    status = {os.path.basename(r.arquivo): r for r in TX.file_status(spark, landed + "/*").collect()}
    assert {n: r.motivo for n, r in status.items()} == {
        "bom.csv": None, "bom.csv.gz": None, "membros.csv.gz": None, "latim.txt": None, "cortado.csv.gz": "truncado",
        "texto.csv.gz": "ilegivel", "outro.csv": "separador_desconhecido", "titulo.csv": "so_cabecalho", "vazio.csv": "vazio",
        "vazio.csv.gz": "vazio"}
    assert status["latim.txt"].codificacao == "ISO-8859-1" and status["latim.txt"].cabecalho == HEAD.strip()
    out = scratch_path(spark, "t-convert")
    done = {os.path.basename(r.arquivo): (r.linhas, r.ruins, r.motivo) for r in FL.convert_many(spark, landed + "/*", out).collect()}
    assert {n for n, r in done.items() if r[0]} == {"bom.csv", "bom.csv.gz", "membros.csv.gz", "latim.txt"}
    assert all(r[0] == 20000 for r in done.values() if r[2] is None) and done["cortado.csv.gz"] == (0, 0, "truncado")
    assert spark.read.parquet(out).count() == 80000


def test_runs_keep_their_quarantine(spark, landed):
    out = scratch_path(spark, "t-runs")
    J.monthly_job(spark, landed + "/{cortado.csv.gz,outro.csv,bom.csv}", out, month="COMPETENCIA_MOV", run="a")
    extra = scratch_path(spark, "t-runs-in")
    spark.createDataFrame([("competência;uf",), ("202102;1;2",), ("2021;3",), ("202102;33",)], "value string").coalesce(1).write.text(extra)
    J.monthly_job(spark, extra + "/*.txt", out, run="b")
    want = [("a", "separador_desconhecido", None), ("a", "truncado", None), ("b", "competencia_invalida", "x"), ("b", "linha_malformada", "x")]
    seen = lambda: sorted((r.execucao, r.motivo, r.linha and "x") for r in J.rejected(spark, out).collect())
    assert seen() == want
    J.monthly_job(spark, extra + "/*.txt", out, run="b")                 # a run that is repeated replaces its own rows
    assert seen() == want
    assert spark.read.parquet(out).count() == 20001


def test_no_readable_file_is_no_error(spark, landed):
    out = scratch_path(spark, "t-none")
    assert J.monthly_job(spark, landed + "/{texto.csv.gz,vazio.csv,outro.csv}", out) is None
    assert sorted(r.motivo for r in J.rejected(spark, out).collect()) == ["ilegivel", "separador_desconhecido", "vazio"]


# --- cells and lines ---------------------------------------------------------------------------------------

def test_one_bad_cell_does_not_abort(spark):
    from jobflow.functions import names as NM
    lines = spark.createDataFrame([("1;SP;1;x;99999999999999999999;5",)], "value string")
    assert [tuple(r)[4:] for r in TX.parse_positional(lines).collect()] == [(0, 5, 0)]
    keyed = spark.createDataFrame([("1e30", "inf", "-2,9")], "admissoes string, desligamentos string, saldo string")
    assert tuple(TX.parse_keyed(keyed).first()) == (0, 0, -2)
    m = NM.with_period(spark.createDataFrame([("abcd",), ("202101",)], "COMPETENCIA_MOV string")).collect()
    assert [(r.ANO, r.MES) for r in m] == [(None, None), (2021, 1)]
    r = to_movements(spark.createDataFrame([("x1", "1", "y")], "id string, tipo_movimentacao string, admitidos string")).first()
    assert r.id is None and r.tipo_movimentacao == "admissao"
    e = to_entities(spark.createDataFrame([("z", "1", "2", "202101", "FOR", "10", "2021")],
                                          "id string, cnpj string, cpf string, competencia_mov string, tipo string, "
                                          "tipo_movimentacao string, competencia_dec string")).first()
    assert e.id is None and e.data is None and e.competencia == "2021-01"


def test_checksum_tells_columns_apart(spark):
    from jobflow.operators import aggregates as A
    sums = [A.checksum(spark.createDataFrame([r], "a string, b string")).first().hash_linhas
            for r in (("a\x1f=b", "c"), ("a", "b\x1f=c"), ("a2=b", "c"), ("a", "2=bc"), (None, "~"), ("~", None))]
    assert len(set(sums)) == len(sums)


def test_quoted_separators_and_bad_lines(spark):
    root = scratch_path(spark, "t-keyed")
    spark.createDataFrame([("CNPJ;município;admissoes",), ('1;"a;b";2',), ('2;"diz ""x;y""";3',), ("3;c",), ("4;d;5;6",), ("",), ('5;"e;";"7"',)],
                          "value string").coalesce(1).write.text(root + "/a")
    spark.createDataFrame([("admissoes;UF;CNPJ",), ("8;SP;9",)], "value string").coalesce(1).write.text(root + "/b")
    rows = {r.cnpj: r for r in TX.read_keyed(spark, root + "/*").collect()}
    assert {k: r.admissoes for k, r in rows.items()} == {"1": 2, "2": 3, "3": 0, "5": 7, "9": 8} and rows["9"].uf == "SP"
    bad = {r.arquivo.split("/")[-2]: (r.linhas, r.ruins) for r in TX.bad_lines(spark, root + "/*").collect()}
    assert bad == {"a": (5, 1), "b": (1, 0)}
    s = {r.CNPJ: (r["município"], r.admissoes) for r in TX.salvage_lines(spark, root + "/a").collect()}
    assert s == {"1": ("a;b", "2"), "2": ('diz "x;y"', "3"), "3": ("c", None), "4": ("d", "5"), "5": ("e;", "7")}


# --- match rule, dense ids ----------------------------------------------------------------------------------

def test_match_ranks(spark):
    names = ["MOV202103_SP_1.7z", "MOV202103_2.7z", "EXC202104_RJ_3.7z", "FOR202105_4.7z", "MOV202201_SP_5.7z", "qualquer.7z", "EXC202106_6.7z"]
    inputs = spark.createDataFrame([(n, 10) for n in names], "file_name string, mtime int")
    outputs = spark.createDataFrame([
        ("MOV202103_SP_1.txt", 5, 1), ("Movimentacao202103_SP.csv", 50, 1),   # the same base wins over a newer one
        ("Movimentacao202103_RJ.csv", 20, 1),
        ("EXCLUSAO202104_SP.csv", 30, 1), ("EXCLUSAO202104.csv", 12, 1),      # another state does not match
        ("FORA_PRAZO_2021.csv", 11, 1), ("FORAPRAZO202106.csv", 11, 1),
        ("MOV202201.csv", 20, 0),                                              # empty
        ("EXC202106_6.txt", 9, 0), ("EXCL_2021_AC.csv", 11, 4)],              # an empty twin, and one with rows
        "out_name string, out_mtime int, out_rows int")
    got = {r.file_name: (r["__rank"], r["__name"]) for r in D.match_outputs(inputs, outputs).collect()}
    assert got == {"MOV202103_SP_1.7z": (1, "MOV202103_SP_1.txt"), "MOV202103_2.7z": (3, "Movimentacao202103_SP.csv"),
                   "EXC202104_RJ_3.7z": (3, "EXCLUSAO202104.csv"), "FOR202105_4.7z": (5, "FORA_PRAZO_2021.csv"),
                   "MOV202201_SP_5.7z": (3, "MOV202201.csv"), "qualquer.7z": (None, None), "EXC202106_6.7z": (5, "EXCL_2021_AC.csv")}
    stale = {r.file_name: (r.motivo, r.nivel) for r in D.stale_by_match(inputs, outputs).collect()}
    assert stale == {"MOV202103_SP_1.7z": ("desatualizada", 1), "MOV202201_SP_5.7z": ("vazia", 3), "qualquer.7z": ("sem_saida", None)}


def test_dense_ids_have_no_gaps(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") % 50).alias("v")).repartition(7)
    got = [tuple(r) for r in with_dense_id(df, ["g", "v"], out="n").orderBy("n").collect()]
    assert [r[0] for r in got] == list(range(1, 1001)) and [r[1:] for r in got] == sorted(r[1:] for r in got)
    hot = with_dense_id(spark.range(5000).select(F.lit("x").alias("k")), ["k"])
    assert hot.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()[:] == (1, 5000, 5000)
    assert with_dense_id(df.limit(0), ["g"]).count() == 0
    plan = with_dense_id(df, ["g"])._jdf.queryExecution().toString()
    assert plan.count("SinglePartition") <= 1 and "Window" in plan       # only the offsets meet in one task


def test_pick_up_keeps_columns_of_later_months(spark):
    from jobflow.streaming import incremental as INC
    root, ckpt, sink = (scratch_path(spark, f"t-k1-{x}") for x in "abc")
    FL.write_monthly(months(spark, [(1, "202101")], "id int, competencia_mov string"), root)
    assert INC.incremental_read(spark, root, ckpt, sink).count() == 1
    FL.write_monthly(months(spark, [(2, "202102", 9.5)], "id int, competencia_mov string, salario double"), root)
    got = {r["id"]: r["salario"] for r in INC.incremental_read(spark, root, ckpt, sink).collect()}
    assert got == {1: None, 2: 9.5}


def test_lateness_on_a_stream_equals_the_batch(spark):
    from jobflow.operators.analytics import lateness
    from jobflow.streaming import incremental as INC
    landing, out, ckpt = (scratch_path(spark, f"t-k3-{x}") for x in "abc")
    rows = [("202101", "202101"), ("202101", "202103"), ("202102", "202102"), ("202101", "202109"), ("202012", "202109")]
    df = months(spark, rows, "competencia_mov string, competencia_dec string")
    for part in (rows[:3], rows[3:]):                                     # the second arrival reaches old months
        months(spark, part, df.schema).write.mode("append").parquet(landing)
        got = INC.lateness_stream(spark, landing, out, ckpt, df.schema)
    again = INC.lateness_stream(spark, landing, out, ckpt, df.schema)     # nothing new
    want = sorted(map(tuple, lateness(df).collect()))
    assert sorted(map(tuple, got.collect())) == want == sorted(map(tuple, again.collect()))


def test_lines_are_not_sorted_by_their_file(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    from jobflow.sources import text as TX
    os.makedirs(tmp_path / "in")
    files = {"a.csv": "é;b\n1;2\n".encode(), "b.csv": b"x;\xe9\n1;2\n", "c.csv": b"x,y\n1,\xe9\n", "d.csv": b""}
    for name, data in files.items():
        (tmp_path / "in" / name).write_bytes(data)
    heads, own, plans = TX.header_lines(spark, f"{tmp_path}/in/*"), DataFrameWriter.parquet, []

    def seen(self, *args, **kw):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return own(self, *args, **kw)
    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    status = TX.file_status(spark, f"{tmp_path}/in/*")
    for plan in (heads._jdf.queryExecution().executedPlan().toString(), *plans):
        assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan
    want = {"a.csv": ("é;b", "UTF-8"), "b.csv": ("x;é", "ISO-8859-1"), "c.csv": ("x,y", "ISO-8859-1")}
    assert len(plans) == 1 and {r.arquivo.rpartition("/")[2]: (r.cabecalho, r.codificacao) for r in heads.collect()} == want
    assert {r.arquivo.rpartition("/")[2]: (r.cabecalho, r.codificacao) for r in status.where("motivo IS NULL").collect()} == want
