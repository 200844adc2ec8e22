import pytest
from pyspark.sql import functions as F

from plumbline.plans.prepared import Prepared
from plumbline.plans.run import train_file
from plumbline.sources import tables


def write(tmp_path, text):
    path = tmp_path / "t.csv"
    path.write_text(text)
    return str(path)


def test_csv_types_and_missing_tokens(spark, tmp_path):
    path = write(tmp_path, "a,b,c,d,e,y\n1,NA,True,x,-3,0\n2,3.5,False,1,4,1\n,1e3,True,,5,1\n")
    df = tables.read_csv(spark, path)
    assert dict(df.dtypes) == {"a": "double", "b": "double", "c": "boolean", "d": "string", "e": "bigint", "y": "bigint"}
    rows = sorted(df.collect(), key=lambda r: r["e"])
    assert [r["b"] for r in rows] == [None, 3.5, 1000.0]
    assert [r["a"] for r in rows] == [1.0, 2.0, None]
    assert [r["c"] for r in rows] == [True, False, True]


@pytest.mark.parametrize("token", tables.NA_TOKENS)
def test_every_missing_token(spark, tmp_path, token):
    df = tables.read_csv(spark, write(tmp_path, f"a,y\n{token},0\n2.5,1\n"))
    assert dict(df.dtypes)["a"] == "double"
    assert sorted((r["a"] for r in df.collect()), key=lambda v: (v is not None, v)) == [None, 2.5]


def test_numbers_with_letters_stay_text(spark, tmp_path):
    df = tables.read_csv(spark, write(tmp_path, "a,b\n1d,0x10\n2f,7\n"))
    assert [t for _, t in df.dtypes] == ["string", "string"]


def test_csv_with_schema(spark, tmp_path):
    df = tables.read_csv(spark, write(tmp_path, "a,y\n1,0\n2,1\n"), "a double, y int")
    assert sorted(map(tuple, df.collect())) == [(1.0, 0), (2.0, 1)]


def test_projection_checks(spark):
    df = spark.createDataFrame([(1, 2.0, True, "x", 0)], "k int, a double, b boolean, s string, y int")
    with pytest.raises(KeyError):
        tables.features(df, "absent")
    with pytest.raises(KeyError):
        tables.labels(df, "absent")
    with pytest.raises(ValueError, match="s .string."):
        tables.features(df, "y", ["k"])
    assert tables.features(df.drop("s"), "y", ["k"]).columns == ["a", "b"]
    assert tables.labelled(df.drop("s"), "y", ["k"]).first().asDict() == {"k": 1, "a": 2.0, "b": 1.0, "y": 0}


@pytest.mark.parametrize("values", [[0, 0], [1, 1], [0, 1, 2], [0, 1, None], []])
def test_labels_must_be_binary(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "y int")
    with pytest.raises(ValueError):
        tables.check_labels(df, "y")


def test_check_labels(spark):
    df = spark.createDataFrame([(0,), (1,), (1,)], "y int")
    assert tables.check_labels(df, "y") == {0: 1, 1: 2}


def test_missing_feature_stops_assembly(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception, match="null"):
        tables.assemble(df, ["a", "b"]).collect()


def test_label_profile(spark):
    df = spark.createDataFrame(
        [("1", 0.0, None, True, 1), ("0", float("nan"), None, False, 1), ("x", 1.0, None, True, 1), ("", 1.0, None, True, 1)],
        "`a.b` string, f double, none int, flag boolean, one int",
    )
    got = {r[0]: tuple(r)[1:] for r in tables.label_profile(df, df.columns).collect()}
    assert got == {
        "a.b": (1, 1, 2, False), "f": (1, 2, 1, False), "none": (0, 0, 4, False), "flag": (1, 3, 0, True), "one": (0, 4, 0, False),
    }
    for c in df.columns:
        if got[c][-1]:
            assert tables.check_labels(df, c) == {0: got[c][0], 1: got[c][1]}
        else:
            with pytest.raises(ValueError):
                tables.check_labels(df, c)
    assert {tuple(r)[1:] for r in tables.label_profile(df.where("false"), df.columns).collect()} == {(0, 0, 0, False)}


def test_class_profile(spark):
    df = spark.createDataFrame([("train", 0, 1.0), ("train", 0, 2.0), ("test", 1, 3.0)], "split string, y int, a double")
    got = {(r["split"], r["y"]): (r["n_rows"], r["n_columns"]) for r in tables.class_profile(df, "y").collect()}
    assert got == {("train", 0): (2, 2), ("test", 1): (1, 2)}


def test_boolean_becomes_number(spark):
    df = spark.range(4).select((F.col("id") % 2 == 0).alias("b"), F.col("id").alias("a"))
    packed = tables.assemble(df, ["b", "a"]).select("features").collect()
    assert sorted(tuple(r[0].toArray()) for r in packed) == [(0.0, 1.0), (0.0, 3.0), (1.0, 0.0), (1.0, 2.0)]


def test_read_table_by_name(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1, 0)], "a int, y int").write.parquet(path)
    assert tables.read_table(spark, path).columns == ["a", "y"]
    assert tables.read_table(spark, write(tmp_path, "a,y\n1,0\n")).dtypes == [("a", "bigint"), ("y", "bigint")]


@pytest.mark.parametrize("bad", [0.9, 1.4, 2.0, None, float("nan")])
def test_wrong_labels_never_reach_a_fit(spark, tmp_path, bad):
    rows = [(i, float(i % 7), float(i % 2)) for i in range(40)] + [(99, 1.0, bad)]
    df = spark.createDataFrame(rows, "k int, a double, y double")
    with pytest.raises(ValueError, match="neither 0 nor 1"):
        Prepared(df, "y", ["k"])
    with pytest.raises(Exception, match="must be 0 or 1"):
        tables.labelled(df, "y", ["k"]).collect()
    path = str(tmp_path / "t.parquet")
    df.write.parquet(path)
    with pytest.raises(ValueError, match="neither 0 nor 1"):
        train_file(spark, path, "dt", str(tmp_path / "out"), "y", ["k"])


def test_csv_with_schema_is_strict(spark, tmp_path):
    df = tables.read_csv(spark, write(tmp_path, "a,b,y\n1.5,True,0\nNA,,1\n"), "a double, b boolean, y int")
    assert sorted(map(tuple, df.collect()), key=str) == [(1.5, True, 0), (None, None, 1)]
    with pytest.raises(Exception, match="not a value of a"):
        tables.read_csv(spark, write(tmp_path, "a,y\nabc,0\n"), "a double, y int").collect()
    with pytest.raises(ValueError, match="columns"):
        tables.read_csv(spark, write(tmp_path, "a,z\n1,0\n"), "a double, y int")


def test_long_integers_keep_their_digits(spark, tmp_path):
    df = tables.read_csv(spark, write(tmp_path, "a,b\n1234567890123456789,1\n1234567890123456788,99999999999999999999\n"))
    assert dict(df.dtypes) == {"a": "bigint", "b": "string"}
    assert df.select("a").distinct().count() == 2


def test_line_breaks_in_cells(spark, tmp_path):
    path = write(tmp_path, 'a,b\n"x\ny",1\n"z",2\n')
    assert sorted(r["a"] for r in tables.read_csv(spark, path, multi_line=True).collect()) == ["x\ny", "z"]
    with pytest.raises(Exception):
        tables.read_csv(spark, path).collect()


def test_parquet_folder_by_its_files(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.createDataFrame([(1, 0)], "a int, y int").write.parquet(path)
    assert tables.read_table(spark, path).columns == ["a", "y"]
    assert tables.read_table(spark, path, kind="parquet").count() == 1
    with pytest.raises(ValueError, match="kind|parquet"):
        tables.read_table(spark, path, kind="orc")


def test_csv_types_cast_only_what_may_be_whole(spark, tmp_path, monkeypatch):
    """Settling the types tries no cast on cells that are no whole numbers, as casts that fail are slow."""
    from plumbline.sources import tables

    path, guarded = str(tmp_path / "t"), []
    rows = [("1:2", "1.5", "7", " 8 ", "99999999999999999999", "True"), ("x", "-2e3", "-9", "+10", "1", "false")]
    spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string").write.csv(path, header=True)
    when = tables.F.when
    monkeypatch.setattr(tables.F, "when", lambda where, value: guarded.append(str(value)) or when(where, value))
    out = tables.read_csv(spark, path)
    assert [t for _, t in out.dtypes] == ["string", "double", "bigint", "bigint", "string", "boolean"]
    assert sum("try_cast" in g.lower() for g in guarded) == 6
