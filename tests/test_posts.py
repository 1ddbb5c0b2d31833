import pytest

from conftest import rows
from tessera.operators import pairs as pr
from tessera.sources.text import format_posts, parse_posts, read_posts


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_java_split_rules(spark):
    got = rows(parse_posts(lines(spark, ["1,10,,,5,,C#", "1,11,,,5,,", "2,12,,10,7,,,"])))
    assert got == [(1, 10, None, None, 5, ""), (1, 11, None, None, 5, None), (2, 12, None, 10, 7, None)]
    with pytest.raises(Exception):
        parse_posts(lines(spark, ["1,10,,,"])).collect()


def test_parse_lines(spark):
    got = rows(parse_posts(lines(spark, ["1,10,11,,5,C#", "2,11,,10,-3,", "2,12,,10,7", "1,13,,,2,Java,extra"])))
    assert got == [(1, 10, 11, None, 5, "C#"), (2, 11, None, 10, -3, None),
                   (2, 12, None, 10, 7, None), (1, 13, None, None, 2, "Java")]


@pytest.mark.parametrize("bad", ["1,10", "1,x,,,5,C#", "1,10,,,five,C#", "1,10,z,,5,C#",
                                 "1, 10,,,5,C#", "1,10,,,5 ,C#", "1,10,,,1.5,C#", "1,10,,,99999999999,C#"])
def test_bad_lines_fail(spark, bad):
    with pytest.raises(Exception):
        parse_posts(lines(spark, [bad])).collect()


def test_posts_file_roundtrip(spark, tmp_path):
    src = parse_posts(lines(spark, ["1,10,11,,5,C#", "2,11,,10,-3,", "2,12,,10,7"]))
    p = str(tmp_path / "posts")
    format_posts(src).write.text(p)
    assert sorted(rows(read_posts(spark, p))) == sorted(rows(src))


FIX = ["1,10,11,,5,C#", "2,11,,10,-3,", "2,12,,10,7", "1,13,,,2,Java", "1,20,,,1,Scala", "2,21,,20,-3", "2,99,,77,4"]


def test_pairs(spark):
    posts = parse_posts(lines(spark, FIX))
    got = sorted(rows(pr.pair_parent_child(posts)))
    assert got == [(10, "C#", 11, -3), (10, "C#", 12, 7), (20, "Scala", 21, -3)]


def test_best_score_and_floor(spark):
    posts = parse_posts(lines(spark, FIX))
    assert sorted(rows(pr.best_child_score(posts))) == [(10, "C#", 7), (20, "Scala", -3)]
    assert sorted(rows(pr.best_child_score(posts, floor=0))) == [(10, "C#", 7), (20, "Scala", 0)]


def test_best_score_equals_pair_then_max(spark):
    from pyspark.sql import functions as F
    posts = parse_posts(lines(spark, FIX))
    via_pairs = pr.pair_parent_child(posts).groupBy("qid", "tag").agg(F.max("score").alias("score"))
    assert sorted(rows(via_pairs)) == sorted(rows(pr.best_child_score(posts)))


def test_answer_without_parent_fails(spark):
    posts = parse_posts(lines(spark, ["1,10,,,5,C#", "2,11,,,3"]))
    with pytest.raises(Exception, match="without parent"):
        pr.best_child_score(posts).collect()
    with pytest.raises(Exception, match="without parent"):
        pr.pair_parent_child(posts).count()
    assert rows(pr.best_child_score(posts, strict=False)) == []
    assert rows(pr.pair_parent_child(posts, strict=False)) == []


def test_strict_check_survives_downstream_filters(spark):
    """Valid data never trips the check, whatever filter sits on top of the join."""
    posts = parse_posts(lines(spark, FIX))
    from pyspark.sql import functions as F
    for cond in (F.col("qid") == 10, F.col("qid").isin(10, 13), F.col("tag") == "C#", F.col("score") > 0):
        assert pr.pair_parent_child(posts).where(cond).count() >= 1
        assert pr.best_child_score(posts).where(cond).count() >= 1


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("Final Plan"):plan.index("Initial Plan")]


def test_best_score_is_one_scan_and_one_shuffle(spark, tmp_path):
    p = str(tmp_path / "posts")
    lines(spark, FIX).write.text(p)
    plan = final_plan(pr.best_child_score(read_posts(spark, p)))
    assert plan.count("FileScan text") == 1 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_strict_pairs_scan_each_side_once(spark, tmp_path):
    p = str(tmp_path / "posts")
    lines(spark, FIX).write.text(p)
    assert final_plan(pr.pair_parent_child(read_posts(spark, p))).count("FileScan text") == 2


def test_repeated_question_id_gives_one_row(spark):
    posts = parse_posts(lines(spark, ["1,10,,,5,Java", "1,10,,,5,C#", "2,11,,10,3"]))
    assert rows(pr.best_child_score(posts)) == [(10, "C#", 3)]


@pytest.mark.parametrize("bad", ["1,10,zz,,5,Java", "1,10", "1,10,,,bad,Java", "1,99999999999999999999,,,1", "9999999999,1,,,1"])
def test_pruned_reads_fail_on_bad_lines(spark, tmp_path, bad):
    p = str(tmp_path / "posts")
    lines(spark, [*FIX, bad]).write.text(p)
    posts = read_posts(spark, p)
    for read in (lambda: posts.select("tag").collect(), posts.count, lambda: pr.best_child_score(posts).collect(),
                 lambda: posts.where("id = 10").collect(), lambda: pr.pair_parent_child(posts).count()):
        with pytest.raises(Exception, match="bad post line"):
            read()
    assert read_posts(spark, p, strict=False).count() == len(FIX) + 1


def test_null_line_fails(spark):
    with pytest.raises(Exception, match="bad post line"):
        parse_posts(lines(spark, [None])).count()


@pytest.mark.parametrize("tag", ["a,b", "a\nb"])
def test_tag_that_would_not_read_back_fails(spark, tag):
    posts = spark.createDataFrame([(1, 1, None, None, 0, tag)], "ptype int, id long, accepted long, parent long, score int, tag string")
    with pytest.raises(Exception, match="separator or line break"):
        format_posts(posts).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_lines_fail_whatever_ansi(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for bad in ["1,10", "1,x,,,5,C#", "1,10,,,99999999999,C#", "1,10,,,1.5,C#"]:
            with pytest.raises(Exception):
                parse_posts(lines(spark, [bad])).collect()
        assert rows(parse_posts(lines(spark, ["2,12,,10,7"]))) == [(2, 12, None, 10, 7, None)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
