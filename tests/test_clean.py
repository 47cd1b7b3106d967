from pyspark.sql import functions as F

from jobflow.functions import clean as CL
from jobflow.functions import names as NM


def test_normalize_name_examples():
    assert NM.normalize_name("Código do Município") == "CODIGO_DO_MUNICIPIO"
    assert NM.normalize_name("Saldo Movimentação") == "SALDO_MOVIMENTACAO"
    assert NM.normalize_name("  ") == "COLUNA_SEM_NOME"


def test_canonical_names_and_misfires():
    assert NM.canonical_name("competênciamov") == "COMPETENCIA_MOV"
    assert NM.canonical_name("unidadesaláriocódigo") == "UNIDADE_SALARIO_CODIGO"
    assert NM.canonical_name("Cidade") == "MUNICIPIO"
    assert NM.canonical_name("idade") == "IDADE"
    assert NM.canonical_name("Grau de Instrução") == "GRAU_INSTRUCAO"
    assert NM.dedupe_names(["A", "A", "B", "A"]) == ["A", "A_2", "B", "A_3"]


def test_invalid_names():
    assert NM.invalid_names(["OK_1", "1X", "a b", ""]) == [("1X", "inicia_com_digito"), ("a b", "caracteres_invalidos"), ("", "vazio")]


def test_value_cleaners(spark):
    rows = [("-",), ("",), ("000",), ("12-3",), ("R$ 1.234,56",), ("7",), (None,)]
    d = spark.createDataFrame(rows, "v string")
    out = d.select(CL.clean_int(F.col("v")).alias("i"), CL.clean_float(F.col("v")).alias("f"),
                   CL.clean_text(F.col("v")).alias("t"), CL.clean_bool(F.col("v")).alias("b")).collect()
    assert [r.i for r in out] == [0, 0, 0, 0, 123456, 7, 0]
    assert [r.f for r in out][4] == 1234.56
    assert out[6].t == "" and out[6].b is False


def test_bool_and_dates(spark):
    d = spark.createDataFrame([(" Sim ",), ("no",), ("talvez",)], "v string")
    assert [r.b for r in d.select(CL.clean_bool(F.col("v")).alias("b")).collect()] == [True, False, False]
    d2 = spark.createDataFrame([("2021-03-05",), ("05/03/2021",), ("20210305",), ("05-03-2021",), ("2021/03/05",), ("x",)], "v string")
    got = [r.d for r in d2.select(CL.parse_date_any(F.col("v")).alias("d")).collect()]
    assert len({str(x) for x in got[:5]}) == 1 and str(got[0]) == "2021-03-05" and got[5] is None


def test_normalize_text_values(spark):
    d = spark.createDataFrame([("Éçà  olá--mundo!",), ("***",), (None,), ("straße_x",)], "v string")
    assert [r.n for r in d.select(CL.normalize_text(F.col("v")).alias("n")).collect()] == [
        "ECA_OLA_MUNDO", "COLUNA_SEM_NOME", None, "STRA_E_X"]


def test_align_adds_typed_defaults(spark):
    d = spark.createDataFrame([("202001", 1)], "COMPETENCIA_MOV string, SALDO_MOVIMENTACAO int")
    a = NM.align(d)
    assert a.columns == NM.STANDARD_COLUMNS
    r = a.collect()[0]
    assert r.ANO == 0 and r.VALOR_SALARIO_FIXO == 0.0 and r.SEXO == ""
