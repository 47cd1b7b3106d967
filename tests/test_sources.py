import os

from pyspark.sql import functions as F

from jobflow.session import scratch_path
from jobflow.sources import catalog as CT
from jobflow.sources import files as FL
from jobflow.sources import text as TX


def test_positional_rules(spark):
    lines = spark.createDataFrame([("1;SP;3550308;loja;5;2",), ("# comentario",), ("",), ("2;RJ;1;x;a;3",),
                                   ("3;MG;2;y;4",), (" 4;BA;5;z;7;9;extra ",)], "value string")
    out = sorted(tuple(r) for r in TX.parse_positional(lines).collect())
    assert out == [("1", "SP", "3550308", "loja", 5, 2, 3), ("2", "RJ", "1", "x", 0, 3, 0), ("4", "BA", "5", "z", 7, 9, -2)]


def test_keyed_aliases_and_lenient_numbers(spark):
    df = spark.createDataFrame([("11", "SP", "3,9", "n/d")], "CNPJ string, UF string, admissoes string, desligamentos string")
    r = TX.parse_keyed(df).collect()[0]
    assert (r.cnpj, r.uf, r.admissoes, r.desligamentos) == ("11", "SP", 3, 0)


def test_salvage_and_header_delimiter(spark):
    p = scratch_path(spark, "t-salvage")
    os.makedirs(p)
    with open(os.path.join(p, "a.txt"), "w") as f:
        f.write("a;b;c\n1;2;3\n\n# nada\nsem separador\n4,5\n6;7\n")
    rows = sorted(tuple(r) for r in TX.salvage_lines(spark, p, "a;b;c").collect())
    assert rows == [("1", "2", "3"), ("4,5", None, None), ("6", "7", None)]
    assert sorted(tuple(r) for r in TX.salvage_lines(spark, p).collect()) == rows     # header found in the file
    d = spark.createDataFrame([("a;b;c",), ("a,b;c,d",), ("x|y",), ("nada",)], "value string")
    assert [r.s for r in d.select(TX.delimiter_of_header(d).alias("s")).collect()] == [";", ",", "|", None]


def test_delimiter_profile_prefers_structural(spark):
    lines = spark.createDataFrame([(1, "a;b;c;d"), (1, "e;f;g;h"), (1, "i,j;k;l;m")], "arquivo int, value string")
    chosen = [r.separador for r in TX.delimiter_profile(lines).where("escolhido").collect()]
    assert chosen == [";"]


def test_partitioned_round_trip_and_period_scan(spark):
    df = spark.createDataFrame([(1, "202101", "MOV"), (2, "202102", "EXC"), (3, "202101", None)],
                               "id int, competencia_mov string, tipo string")
    root = scratch_path(spark, "t-layout")
    FL.write_monthly(df, root)
    back = FL.read_period(spark, root, [(2021, 1)], "MOV")
    assert sorted(r.id for r in back.collect()) == [1, 3]           # missing type defaults to MOV
    FL.write_monthly(df.where("id = 1").withColumn("id", F.lit(10)), root)   # dynamic overwrite of one month
    assert sorted(r.id for r in spark.read.parquet(root).collect()) == [2, 10]


def test_file_name_metadata(spark):
    c = spark.createDataFrame([("MOV202401_1.7z",), ("EXC202312_2.txt",), ("outro.csv",)], "file_name string")
    rows = {r.file_name: (r.tipo, r.ano, r.mes, r.extensao, r.modalidade) for r in CT.with_file_meta(c).collect()}
    assert rows["MOV202401_1.7z"] == ("MOV", 2024, 1, "7z", "compactado")
    assert rows["EXC202312_2.txt"] == ("EXC", 2023, 12, "txt", "texto")
    assert rows["outro.csv"] == ("outros", None, None, "csv", "texto")


def test_read_delimited_keeps_corrupt_lines(spark):
    p = scratch_path(spark, "t-corrupt")
    os.makedirs(p)
    with open(os.path.join(p, "a.csv"), "w") as f:
        f.write("a;b\n1;2\nx;3\n4;5;6\n")
    rows = sorted(TX.read_delimited(spark, p, schema="a int, b int", keep_corrupt=True).collect(), key=lambda r: str(r.a))
    assert [(r.a, r.b) for r in rows] == [(1, 2), (4, 5), (None, 3)]
    assert rows[2][TX.CORRUPT] == "x;3"


def test_per_file_counts_skips_corrupt_file(spark):
    root = scratch_path(spark, "t-corruptfile")
    spark.range(5).write.parquet(root)
    with open(os.path.join(root, "part-99999-broken.parquet"), "w") as f:
        f.write("not parquet")
    counts = FL.per_file_counts(spark, root).agg(F.sum("linhas").alias("n")).collect()[0].n
    assert counts == 5


def test_incremental_pickup_sees_only_new_files(spark):
    from jobflow.streaming.incremental import incremental_read
    root, ck, sink = scratch_path(spark, "t-k1-in"), scratch_path(spark, "t-k1-ck"), scratch_path(spark, "t-k1-out")
    df = spark.createDataFrame([(1, "202101", "MOV")], "id int, competencia_mov string, tipo string")
    FL.write_monthly(df, root)
    assert incremental_read(spark, root, ck, sink).count() == 1
    FL.write_monthly(spark.createDataFrame([(2, "202102", "MOV")], "id int, competencia_mov string, tipo string"), root)
    out = incremental_read(spark, root, ck, sink)
    assert sorted(r.id for r in out.collect()) == [1, 2]          # month 1 not re-read, month 2 appended once


def test_catalog_from_landed_files_and_cnae_loader(spark):
    from jobflow.operators.filters import load_cnae
    root = scratch_path(spark, "t-landed")
    os.makedirs(os.path.join(root, "2024"))
    for n in ["MOV202401.txt", "EXC202401.txt", "notas.md"]:
        with open(os.path.join(root, "2024", n), "w") as f:
            f.write("x" * 10)
    cat = CT.catalog_from_files(spark, root, glob="*.txt")
    assert sorted((r.file_name, r.tipo, r.size_bytes) for r in cat.collect()) == [
        ("EXC202401.txt", "EXC", 10), ("MOV202401.txt", "MOV", 10)]
    cnae = os.path.join(root, "cnae.csv")
    with open(cnae, "w") as f:
        f.write("CLASSE_CNAE;SITUACAO\n01111;1\n01112;0\n01113;1\n")
    assert sorted(r.code for r in load_cnae(spark, cnae).collect()) == ["01111", "01113"]


def test_profile_files_picks_separator_per_file(spark):
    root = scratch_path(spark, "t-profile")
    os.makedirs(root)
    with open(os.path.join(root, "a.txt"), "w") as f:
        f.write("".join(f"{i};x;y;z\n" for i in range(20)))
    with open(os.path.join(root, "b.txt"), "w") as f:
        f.write("".join(f"{i}|x|y|z\n" for i in range(20)))
    chosen = {r.arquivo.rsplit("/", 1)[-1]: r.separador for r in TX.profile_files(spark, root).where("escolhido").collect()}
    assert chosen == {"a.txt": ";", "b.txt": "|"}


def test_header_lines_per_file(spark):
    root = scratch_path(spark, "t-headers")
    os.makedirs(root)
    for name, head, sep in [("a.csv", "x;y;z", ";"), ("b.csv", "p,q", ","), ("c.csv", "k\tv", "\t")]:
        with open(os.path.join(root, name), "w") as f:
            f.write(head + "\n" + "".join(f"{i}{sep}{i}\n" for i in range(50)))
    got = {r.arquivo.rsplit("/", 1)[-1]: (r.cabecalho, r.separador) for r in TX.header_lines(spark, root).collect()}
    assert got == {"a.csv": ("x;y;z", ";"), "b.csv": ("p,q", ","), "c.csv": ("k\tv", "\t")}


def test_salvage_splits_by_the_reference_order_and_each_files_header(spark):
    root = scratch_path(spark, "t-salvage2")
    spark.createDataFrame([("a;b,c,d",), ("1;2,3,4",)], "value string").coalesce(1).write.text(root + "/x")
    spark.createDataFrame([("b,a",), ("9,8",)], "value string").coalesce(1).write.text(root + "/y")
    got = {tuple(r.asDict().items()) for r in TX.salvage_lines(spark, root + "/*").collect()}
    assert got == {(("a", "1"), ("b,c,d", "2,3,4"), ("b", None)), (("a", "8"), ("b,c,d", None), ("b", "9"))}


def test_monthly_job_reads_swapped_columns_by_name(spark):
    from jobflow.plans.jobs import monthly_job
    root, out = scratch_path(spark, "t-n1"), scratch_path(spark, "t-n1-out")
    spark.createDataFrame([("uf;região;competênciamov",), ("35;3;202101",), ("35;3;2021",)], "value string").coalesce(1).write.text(root + "/a")
    spark.createDataFrame([("região;uf;competênciamov",), ("3;33;202102",), ("1;2",)], "value string").coalesce(1).write.text(root + "/b")
    assert monthly_job(spark, root + "/*/*.txt", out) is None
    got = {(r.uf, r.regiao, r.ano, r.mes) for r in spark.read.parquet(out).collect()}
    assert got == {("35", "3", 2021, 1), ("33", "3", 2021, 2)}
    bad = sorted((r.motivo, r.linha) for r in spark.read.parquet(out + "_quarentena").collect())
    assert [m for m, _ in bad] == ["competencia_invalida", "linha_malformada"] and bad[1][1] == "1;2"


def test_whole_words_name_fields():
    from jobflow.functions import names as NM
    assert [NM.canonical_name(n) for n in ("Quantidade", "Localidade", "Cidade", "Unidade Federação", "Idade", "Straße")] == [
        "QUANTIDADE", "LOCALIDADE", "MUNICIPIO", "UF", "IDADE", "STRA"]
    assert NM.normalize_name("Straße  nº1") == "STRA_E_N_1" and NM.normalize_name("--") == "COLUNA_SEM_NOME"


def test_file_hashes_leave_large_files_unread(spark):
    root = scratch_path(spark, "t-hash")
    spark.createDataFrame([("abc",)], "value string").coalesce(1).write.text(root)
    small = TX.file_hashes(spark, root + "/*.txt").first()
    assert small.bytes == 4 and small.md5 == "0bee89b07a248e27c83fc3d5951213c1"
    assert TX.file_hashes(spark, root + "/*.txt", limit=3).first().sha256 is None


def test_file_hashes_read_files_of_any_size(spark):
    import hashlib
    root = scratch_path(spark, "t-hash-large")
    spark.range(400000).selectExpr("repeat(id, 2) AS value").coalesce(1).write.text(root)
    want = TX.file_hashes(spark, root + "/*.txt").first()
    data = open(want.arquivo.removeprefix("file:"), "rb").read()
    assert len(data) > 3 * TX.HASH_CHUNK and want.sha256 == hashlib.sha256(data).hexdigest()
    assert TX.file_hashes(spark, root + "/*.txt", whole=3).first() == want  # in chunks
    assert TX.file_hashes.__defaults__[0] is None  # by default no file is left unread


def test_built_inputs_share_one_stored_join(spark, monkeypatch):
    from jobflow.plans import source_queries as SQ
    monkeypatch.setattr(SQ, "_LAYOUTS", {})
    seen = []
    monkeypatch.setattr(SQ.FL, "write_monthly", lambda df, root, **kw: seen.append(df))
    SQ._drift(spark, "/root/testdata/sf0.001")
    assert len(seen) == 3 and not any("Join" in df._jdf.queryExecution().optimizedPlan().toString() for df in seen)


def test_malformed_lines_are_written_by_many_tasks(spark, monkeypatch):
    from jobflow.plans import source_queries as SQ
    monkeypatch.setattr(SQ, "_LAYOUTS", {})
    root = SQ._landed(spark, "/root/testdata/sf0.001")
    lines = spark.read.text(f"{root}/d/*.csv").collect()
    files = spark.read.text(f"{root}/d/*.csv").inputFiles()
    assert len(files) > 1 and sum(r.value == ";".join(SQ.RT_COLS) for r in lines) == len(files)


def test_few_partition_values_are_written_unsorted(spark):
    from jobflow.plans import source_queries as SQ
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with SQ._unsorted(spark):
        assert int(spark.conf.get(name)) >= 5
    assert spark.conf.get(name) == before


def test_the_stored_join_is_planned_alike_at_any_size(spark, monkeypatch):
    from jobflow.plans import source_queries as SQ
    plans, own = [], SQ.mov
    monkeypatch.setattr(SQ, "_LAYOUTS", {})

    def seen(*args, **kw):
        df = own(*args, **kw)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df
    monkeypatch.setattr(SQ, "mov", seen)
    SQ.moves(spark, "/root/testdata/sf0.001", SQ.RT_COLS)
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
