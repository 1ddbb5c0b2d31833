import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tessera.operators import survey as sv
from tessera.sources.widecsv import read_wide_csv, schema_from_header


def test_schema_from_header():
    s = schema_from_header(["respondent", "weight", "t010101"])
    assert [f.name for f in s.fields] == ["respondent", "weight", "t010101"]
    assert isinstance(s.fields[0].dataType, T.StringType)
    assert all(isinstance(f.dataType, T.DoubleType) for f in s.fields[1:])
    assert not any(f.nullable for f in s.fields)


def test_classify_columns():
    """Every class prefix with longer codes behind it, shuffled among names of no class."""
    names = ["tesex", "t189999", "t180399", "t110207", "x01", "t180501", "t020904", "t050389", "t170101", "t0301",
             "t180101", "t1", "t160102", "t010299", "teage", "t140101", "T010101"]
    p, w, o = sv.classify_columns(names)
    assert p == ["t180399", "t110207", "t0301", "t180101", "t010299"]
    assert w == ["t180501", "t050389"]
    assert o == ["t189999", "t020904", "t160102", "t140101"]


SCHEMA = "id string, telfs double, tesex double, teage double, t01 double, t05 double, t02 double"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_recodes(spark):
    data = [("a", 1.0, 1.0, 14.0, 90.0, 0.0, 0.0), ("b", 2.0, 2.0, 15.0, 0.0, 30.0, 0.0),
            ("c", 0.0, 2.0, 22.0, 0.0, 0.0, 60.0), ("d", 3.0, 1.0, 23.0, 0.0, 0.0, 0.0),
            ("e", 5.0, 1.0, 55.0, 0.0, 0.0, 0.0), ("f", 2.9, 3.0, 56.0, 0.0, 0.0, 0.0),
            ("g", 1.0, 1.0, float("nan"), 0.0, 0.0, 0.0)]
    got = rows(sv.summarize_time(frame(spark, data), ["t01"], ["t05"], ["t02"]))
    assert got == [("working", "male", "active", 1.5, 0.0, 0.0),
                   ("working", "female", "young", 0.0, 0.5, 0.0),
                   ("not working", "female", "young", 0.0, 0.0, 1.0),
                   ("not working", "male", "active", 0.0, 0.0, 0.0),
                   ("not working", "male", "active", 0.0, 0.0, 0.0),
                   ("working", "female", "elder", 0.0, 0.0, 0.0),
                   ("working", "male", "active", 0.0, 0.0, 0.0)]
    emp = rows(sv.summarize_time(frame(spark, data), ["t01"], ["t05"], ["t02"], exclude_unemployable=True))
    assert len(emp) == 6


def test_unknown_labour_status_is_not_unemployable(spark):
    data = [("a", None, 1.0, 30.0, 0.0, 0.0, 0.0), ("b", 5.0, 1.0, 30.0, 0.0, 0.0, 0.0)]
    assert sv.summarize_time(frame(spark, data), ["t01"], ["t05"], ["t02"], exclude_unemployable=True).count() == 1


def test_sql_form_takes_its_columns(spark):
    df = spark.createDataFrame([("x", "y", 1.234), ("x", "y", 2.0)], "a string, `b c` string, `m{}` double")
    kwargs = {"keys": ("a", "b c"), "measures": ("m{}",), "scale": 2}
    assert rows(sv.average_by_group_sql(df, **kwargs)) == rows(sv.average_by_group(df, keys=("a", "b c"), measures=("m{}",), scale=2))


def test_empty_class_rejected(spark):
    with pytest.raises(ValueError):
        sv.summarize_time(frame(spark, [("a", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]), [], ["t05"], ["t02"])


def test_three_forms_agree_and_round_half_up(spark):
    data = [("a", 1.0, 1.0, 30.0, 6.0, 0.0, 0.0), ("b", 1.0, 1.0, 30.0, 24.0, 0.0, 0.0),
            ("c", 0.0, 2.0, 60.0, 60.0, 60.0, 60.0)]
    summ = sv.summarize_time(frame(spark, data), ["t01"], ["t05"], ["t02"])
    a = rows(sv.average_by_group(summ))
    b = rows(sv.average_by_group_sql(summ))
    c = rows(sv.average_by_group_typed(summ))
    assert a == b == c
    assert a == [("not working", "female", "elder", 1.0, 1.0, 1.0), ("working", "male", "active", 0.3, 0.0, 0.0)]


def test_conform_checks(spark):
    df = spark.createDataFrame([("w", "m", "a", 1, 2.0, 3.0)],
                               "working string, sex string, age string, primaryNeeds int, work double, other double")
    assert rows(sv.conform(df)) == [("w", "m", "a", 1.0, 2.0, 3.0)]
    with pytest.raises(ValueError):
        sv.conform(df.drop("other"))
    wide = spark.createDataFrame([(1, 2.5)], "n int, x float")
    to = T.StructType([T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType())])
    assert rows(sv.conform(wide, to)) == [(1, 2.5)] and sv.conform(wide, to).schema["n"].dataType == T.LongType()
    with pytest.raises(TypeError):
        sv.conform(sv.conform(wide, to), wide.schema)
    narrow = T.StructType([T.StructField("work", T.IntegerType())])
    with pytest.raises(TypeError):
        sv.conform(df, narrow)


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_read_wide_csv_keeps_quotes(spark, tmp_path):
    p = write(tmp_path, "two.csv", 'case,metro,region,school\n"70011",3,-2,17\n"70012",4,-2,18\n')
    names, df = read_wide_csv(spark, p)
    assert names == ["case", "metro", "region", "school"]
    assert rows(df)[0] == ('"70011"', 3.0, -2.0, 17.0)
    _, df2 = read_wide_csv(spark, p, quote='"')
    assert rows(df2)[0][0] == "70011"


def test_typed_row_fields(spark, tmp_path):
    p = write(tmp_path, "row.csv", "a,b,c,d,e\n00042,0.5,-7,1e3,12\n")
    _, df = read_wide_csv(spark, p)
    assert rows(df) == [("00042", 0.5, -7.0, 1000.0, 12.0)]


@pytest.mark.parametrize("body", ["x,1\n", "x,1,2,3\n", "x,1,abc\n", "x,,2\n"])
def test_malformed_csv_fails(spark, tmp_path, body):
    p = write(tmp_path, "bad.csv", "id,a,b\n" + body)
    _, df = read_wide_csv(spark, p)
    with pytest.raises(Exception):
        df.collect()


@pytest.mark.parametrize("body", ["x,1\n", "x,1,2,3\n", "x,1,abc\n", "x,,2\n", "x,1,\n"])
@pytest.mark.parametrize("quote", ["", '"'])
def test_pruned_csv_reads_fail(spark, tmp_path, body, quote):
    p = write(tmp_path, "bad.csv", "id,a,b\ny,1,2\n" + body)
    _, df = read_wide_csv(spark, p, quote=quote)
    for read in (lambda: df.select("a").collect(), df.count, lambda: df.where("a = 1").select("id").collect()):
        with pytest.raises(Exception):
            read()


@pytest.mark.parametrize("quote", ["", '"'])
def test_other_header_fails(spark, tmp_path, quote):
    d = tmp_path / "parts"
    d.mkdir()
    (d / "p1.csv").write_text("id,a,b\nx,1,2\n")
    (d / "p2.csv").write_text("id,b,a\ny,3,4\n")
    _, df = read_wide_csv(spark, str(d), quote=quote)
    with pytest.raises(Exception):
        df.collect()


def test_trailing_empty_names_are_dropped(spark, tmp_path):
    p = write(tmp_path, "tail.csv", "id,a,,\nx,1,,\ny,2\n")
    names, df = read_wide_csv(spark, p)
    assert names == ["id", "a"] and rows(df) == [("x", 1.0), ("y", 2.0)]


def test_lenient_csv(spark, tmp_path):
    p = write(tmp_path, "len.csv", "id,a,b\nx,1,abc\ny,2\n")
    _, df = read_wide_csv(spark, p, strict=False)
    assert rows(df) == [("x", 1.0, None), ("y", 2.0, None)]


def test_header_skipped_per_file(spark, tmp_path):
    d = tmp_path / "parts"
    d.mkdir()
    (d / "p1.csv").write_text("id,a\nx,1\n")
    (d / "p2.csv").write_text("id,a\ny,2\n")
    names, df = read_wide_csv(spark, str(d))
    assert names == ["id", "a"] and sorted(rows(df)) == [("x", 1.0), ("y", 2.0)]


def test_wide_row_sum_fold_equals_chain(spark):
    """Hundreds of activity columns: the fold gives the left-to-right doubles.

    (A chain of this many additions overflows the JVM stack while the column
    is converted, which is one reason for the fold.)
    """
    from pyspark.sql import functions as F

    from tessera.functions.recode import row_sum
    n = 320
    names = [f"t01{i:04d}" for i in range(n)]
    df = spark.range(300).select(*[(F.rand(i) * 1000 / 7).alias(c) for i, c in enumerate(names)]).cache()
    got = df.select(row_sum(names, as_double=True).alias("s"), *names).collect()
    for r in got:
        acc = r[names[0]]
        for c in names[1:]:
            acc = acc + r[c]
        assert r["s"] == acc
    p, w, o = sv.classify_columns(["tucaseid", "telfs", "tesex", "teage", *names])
    assert len(p) == n
    summary = sv.summarize_time(df.select(F.lit("x").alias("tucaseid"), F.lit(1.0).alias("telfs"),
                                          F.lit(1.0).alias("tesex"), F.lit(30.0).alias("teage"),
                                          F.lit(5.0).alias("t050101"), F.lit(7.0).alias("t020101"), *names),
                                p, ["t050101"], ["t020101"])
    assert summary.count() == 300


def test_compiled_row_sums_equal_the_chain(spark):
    """Steps of any width add in the chain's order; nulls and NaN as in it; names with dots, shared columns."""
    import random

    rng = random.Random(5)
    names = [f"c.{i}" for i in range(150)]
    data = [[rng.choice([1e16, -1e16, 1.0, 0.1, 3.7]) for _ in names] for _ in range(20)]
    data[3][70], data[4][149], data[5][0] = None, float("nan"), None
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id int, " + ", ".join(f"`{n}` double" for n in names))

    def chain(r, cols):
        out = r[cols[0]]
        for c in cols[1:]:
            out = None if out is None or r[c] is None else out + r[c]
        return out

    sums = {"all": range(150), "some": range(10, 40), "again": range(0, 150, 2)}
    for step in (1, 7, 64, 1000):
        if step == 1:
            sums = {k: list(v)[:5] for k, v in sums.items()}
        else:
            sums = {"all": range(150), "some": range(10, 40), "again": range(0, 150, 2)}
        got = sv.with_row_sums(df, {k: [names[i] for i in v] for k, v in sums.items()}, ["id"], step=step)
        assert got.columns == ["id", *sums]
        for r in got.collect():
            for k, v in sums.items():
                want = chain(data[r.id], list(v))
                assert r[k] == want or (want is not None and want != want and r[k] != r[k])
    with pytest.raises(ValueError):
        sv.with_row_sums(df, {"none": []})


def test_long_sums_are_not_merged_nor_interpreted(spark):
    names = [f"t01{i:04d}" for i in range(200)]
    df = spark.range(3).select(F.lit(1.0).alias("telfs"), F.lit(1.0).alias("tesex"), F.lit(30.0).alias("teage"),
                               *[(F.col("id") * i).cast("double").alias(n) for i, n in enumerate(names)])
    summed = sv.summarize_time(df, names, names[:3], names[3:5])
    plan = summed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") >= 4 and "aggregate(" not in plan
    assert [r.primaryNeeds for r in summed.collect()] == [i * sum(range(200)) / 60 for i in range(3)]
