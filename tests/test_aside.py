"""Bad rows put aside in one scan; header lines by their place."""

import pytest

from conftest import rows
from tessera.sources.aside import TooManyBadRows, set_aside
from tessera.sources.markup import load_marked
from tessera.sources.text import load_posts, mark_posts, parse_posts
from tessera.sources.widecsv import load_wide_csv, read_wide_csv


def put(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


LINES = ["1,10,11,,5,C#", "2,11,,10,-3,", "1,10", "", "1,x,,,5,C#", "1,10,,,1.5,C#", "2,12,,10,7", "1,10,z,,5,C#", "1,13,,,2,Java,extra"]


def test_posts_split_in_two(spark, tmp_path):
    src = put(tmp_path, "posts.csv", "\n".join(LINES) + "\n")
    got = load_posts(spark, src, str(tmp_path / "out"))
    good = [LINES[i] for i in (0, 1, 6, 8)]
    assert sorted(rows(got.good)) == sorted(rows(parse_posts(spark.createDataFrame([(v,) for v in good], "value string"))))
    assert sorted((r.raw, r.reason) for r in got.bad.collect()) == [
        ("", "fewer than 5 fields"), ("1,10", "fewer than 5 fields"), ("1,10,,,1.5,C#", "bad number: score"),
        ("1,10,z,,5,C#", "bad number: accepted"), ("1,x,,,5,C#", "bad number: id")]
    assert {r.file.rsplit("/", 1)[1] for r in got.bad.collect()} == {"posts.csv"}
    assert (got.n_good, got.n_bad) == (4, 5)
    with pytest.raises(TooManyBadRows):
        load_posts(spark, src, str(tmp_path / "few"), max_bad=4)


def test_one_scan_and_null_lines(spark, tmp_path):
    marked = mark_posts(spark.createDataFrame([("1,10,11,,5,C#",), (None,)], "value string"))
    got = set_aside(marked, str(tmp_path / "out"))
    assert [tuple(r) for r in got.bad.collect()] == [(None, "null line")] and got.n_good == 1
    source = put(tmp_path, "p.csv", "1,10,11,,5,C#\n")
    plan = mark_posts(spark.read.text(source))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    for side in (got.good, got.bad):  # read from the written table, the other folder pruned
        text = side._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in text and "good" in text.split("PartitionFilters:")[1].split("]")[0]


def test_wide_csv_split_in_two(spark, tmp_path):
    src = put(tmp_path, "w.csv", "id,a,b\nx,1,2\ny,1\nz,1,abc\nu,,2\nid,a,b\nv,3,4\nw,1,2,3\n")
    names, got = load_wide_csv(spark, src, str(tmp_path / "out"))
    assert names == ["id", "a", "b"] and sorted(rows(got.good)) == [("v", 3.0, 4.0), ("x", 1.0, 2.0)]
    assert sorted((r.raw, r.reason) for r in got.bad.collect()) == [
        ("id,a,b", "bad or empty number: a"), ("u,,2", "bad or empty number: a"), ("w,1,2,3", "not 3 fields"),
        ("y,1", "not 3 fields"), ("z,1,abc", "bad or empty number: b")]


def test_markup_split_in_two(spark, tmp_path):
    def line(t, x):
        return f"<page> <title>{t}</title><text>{x}</text>  </page>"
    src = put(tmp_path, "a.txt", "\n".join([line("A", "one"), "nothing here", line("B", ""), "<page> <title>C</title><text>cut"]) + "\n")
    got = load_marked(spark, src, str(tmp_path / "out"))
    assert sorted(rows(got.good)) == [("A", "one"), ("B", "")]
    assert sorted((r.raw, r.reason) for r in got.bad.collect()) == [
        ("<page> <title>C</title><text>cut", "too short"), ("nothing here", "no marker")]


@pytest.mark.parametrize("quote", ["", '"'])
def test_line_equal_to_the_header_is_data(spark, tmp_path, quote):
    one = put(tmp_path, "one.csv", "name\nanna\nname\nbert\n")
    assert rows(read_wide_csv(spark, one, quote=quote)[1]) == [("anna",), ("name",), ("bert",)]
    several = put(tmp_path, "several.csv", "id,a\nx,1\nid,a\n")
    with pytest.raises(Exception, match="bad or empty number: a"):
        read_wide_csv(spark, several, quote=quote)[1].collect()
