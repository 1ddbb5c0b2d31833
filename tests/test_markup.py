import pytest

from conftest import rows
from tessera.sources.markup import extract_marked


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_article_layout(spark):
    line = "x" * 14 + "T" + "</title><text>" + "body" + "y" * 16
    assert rows(extract_marked(lines(spark, [line]))) == [("T", "body")]


def test_wiki_like_line(spark):
    line = "<page><title> Scala</title><text>Scala is a language</text></page>  "
    # prefix and suffix lengths are parameters
    got = rows(extract_marked(lines(spark, [line]), prefix_len=13, suffix_len=len("</text></page>  ")))
    assert got == [(" Scala", "Scala is a language")]


def test_start_marker(spark):
    html = "<html><head><title>Hi there</title></head><body>x</body></html>"
    got = rows(extract_marked(lines(spark, [html]), start_marker="<title>", marker="</title>",
                              suffix_len=len("</body></html>")))
    assert got == [("Hi there", "</head><body>x")]


def test_missing_marker_fails(spark):
    with pytest.raises(Exception, match="markup without"):
        extract_marked(lines(spark, ["no marker here at all, none"])).collect()


def test_short_line_fails(spark):
    with pytest.raises(Exception):
        extract_marked(lines(spark, ["x" * 14 + "T</title><text>ab"])).collect()


def test_lenient_modes(spark):
    df = lines(spark, ["bad", "x" * 14 + "T</title><text>body" + "y" * 16])
    assert rows(extract_marked(df, on_error="drop")) == [("T", "body")]
    assert sorted(rows(extract_marked(df, on_error="null")), key=str) == sorted([(None, None), ("T", "body")], key=str)


def test_null_line_is_an_error(spark):
    df = spark.createDataFrame([(None,)], "value string")
    with pytest.raises(Exception):
        extract_marked(df).collect()
    assert extract_marked(df, on_error="drop").collect() == []
    assert [tuple(r) for r in extract_marked(df, on_error="null").collect()] == [(None, None)]
