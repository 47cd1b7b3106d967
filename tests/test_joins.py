from jobflow.operators import joins as D
from jobflow.operators import windows as W


def test_prefer_source_keeps_lowest_rank(spark):
    rows = [(1, "c", "p", "202001", 3, 10.0), (2, "c", "p", "202001", 1, 20.0), (3, "c", "p", "202001", 2, 30.0),
            (4, "c", "q", "202001", 3, 40.0)]
    d = spark.createDataFrame(rows, "id int, cnpj string, cpf string, comp string, origem_informacao int, v double")
    out = sorted((r.cpf, r.id) for r in D.prefer_source(d, ["cnpj", "cpf", "comp"], tiebreak=["id"]).collect())
    assert out == [("p", 2), ("q", 4)]


def test_impute_only_missing_separations(spark):
    cols = "id int, cnpj string, cpf string, comp string, tipo_movimentacao string"
    main = spark.createDataFrame([(1, "c", "p", "202001", "10")], cols)
    ew = spark.createDataFrame([(2, "c", "p", "202001", "31"), (3, "c", "x", "202001", "31"), (4, "c", "y", "202001", "10")], cols)
    out = sorted(r.id for r in D.impute_separations(main, ew, key=["cnpj", "cpf", "comp"]).collect())
    assert out == [1, 3]


def test_month_gaps(spark):
    d = spark.createDataFrame([("a", "202001"), ("a", "202004"), ("a", "202005"), ("b", "202012"), ("b", "202102")],
                              "k string, competencia_mov string")
    g = sorted(tuple(r) for r in W.month_gaps(d, by=["k"]).collect())
    assert g == [("a", "202002", "202003", 2), ("b", "202101", "202101", 1)]


def test_impute_in_one_table_equals_two_frame_form(spark):
    from pyspark.sql import functions as F
    rows = [(1, "c", "p", "202001", "10", 1), (2, "c", "p", "202001", "31", 3), (3, "c", "x", "202001", "31", 3),
            (4, "c", "y", "202001", "10", 3), (5, "d", "x", "202001", "40", 2)]
    df = spark.createDataFrame(rows, "id int, cnpj string, cpf string, comp string, tipo_movimentacao string, origem int")
    key = ["cnpj", "cpf", "comp"]
    one = sorted(r.id for r in D.impute_separations_in(df, key=key, is_main=F.col("origem").isin(1, 2)).collect())
    two = sorted(r.id for r in D.impute_separations(df.where("origem in (1, 2)"), df.where("origem = 3"), key=key).collect())
    assert one == two == [1, 3, 5]


def test_matching_lists_keys_of_classes_not_of_files(spark):
    """Only what remains after grouping is turned into keys, so their number does not grow with the files."""
    inputs = spark.createDataFrame([(f"MOV2021{k % 12 + 1:02d}_SP_{k}.7z",) for k in range(50)], "file_name string")
    outputs = spark.createDataFrame([("MOV202103_SP_2.csv", 1, 5), ("MOVIMENTACAO_2021.csv", 2, 0)], "out_name string, out_mtime int, out_rows int")
    got = D.match_outputs(inputs, outputs)
    lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    generates = [k for k, x in enumerate(lines) if "Generate" in x]
    assert generates
    for k in generates:
        below = next((n for n in range(k + 1, len(lines)) if depth[n] <= depth[k]), len(lines))
        assert any("Aggregate" in x for x in lines[k:below])
    found = {r.file_name: (r["__rank"], r["__name"]) for r in got.collect()}
    assert found["MOV202103_SP_2.7z"] == (1, "MOV202103_SP_2.csv") and found["MOV202103_SP_14.7z"] == (2, "MOV202103_SP_2.csv")
    assert found["MOV202101_SP_0.7z"] == (5, "MOVIMENTACAO_2021.csv")
