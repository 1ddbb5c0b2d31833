"""Index blocks, long term lists, bucketed posts, SQL functions."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.recode import age_band, minutes_to_hours, sex_band, working_band
from tessera.functions.sql import register_sql
from tessera.functions.text import has_token, matching_terms
from tessera.operators import bucketed as bk
from tessera.operators import membership as mb
from tessera.operators import pairs as pr
from tessera.operators import postings as po
from tessera.operators import terms as tm
from tessera.session import scratch_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-(2**62), 2**62) | st.integers(-300, 300)), max_size=60))
def test_blocks_hold_the_postings(spark, postings):
    df = spark.createDataFrame(postings, "term string, doc_id bigint")
    blocks = po.build_blocks(df, block_size=7, page_size=100)
    got = blocks.collect()
    assert sorted(rows(po.postings_of(blocks))) == sorted(set(postings))
    for r in got:
        assert 1 <= r.n <= 7 and len(r.deltas) == r.n and r.first_id + sum(r.deltas) == r.last_id
        assert r.first_id // 100 == r.last_id // 100 == r.page
    assert {r.term: r.n_docs for r in po.rank_from_blocks(blocks).collect()} == {
        t: len({i for s, i in postings if s == t}) for t in {s for s, _ in postings}}
    both = {i for t, i in postings if t == "a"} & {i for t, i in postings if t == "b"}
    assert sorted(r.doc_id for r in po.intersect_terms(blocks, "a", "b").collect()) == sorted(both)


def test_headers_alone_are_counted_and_blocks_skipped(spark, tmp_path):
    ids = [("common", i) for i in range(4000)] + [("rare", i) for i in (5, 3990)] + [("none", 10**6)]
    path = str(tmp_path / "blocks")
    po.build_blocks(spark.createDataFrame(ids, "term string, doc_id bigint"), block_size=16, page_size=512).write.parquet(path)
    blocks = spark.read.parquet(path)
    assert "deltas" not in plan(po.rank_from_blocks(blocks))
    assert blocks.where("term = 'common'").count() == 250 + 0 and po.overlapping(blocks, "common", "rare").count() == 2
    assert sorted(r.doc_id for r in po.intersect_terms(blocks, "rare", "common").collect()) == [5, 3990]
    assert po.intersect_terms(blocks, "none", "common").count() == 0 == po.intersect_terms(blocks, "absent", "common").count()
    with pytest.raises(TypeError):
        po.build_blocks(spark.createDataFrame([("a", "x")], "term string, doc_id string"))


def test_million_terms_filter_what_is_shuffled(spark):
    terms = spark.range(1_000_000).select(F.concat(F.lit("w"), F.col("id") * 7).alias("term"))
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat_ws(
        " ", *[F.concat(F.lit("w"), F.col("id") * 50 + k) for k in range(50)]).alias("text"))
    exact = docs.select(F.explode(F.split("text", " ")).alias("term")).join(terms, "term", "left_semi").count()
    admitted = mb.doc_tokens(docs, terms).count()
    assert exact <= admitted < exact * 1.1 and exact * 6 < 100_000
    got = rows(mb.rank_term_table(docs, terms))
    assert len(got) == exact and {n for _, n in got} == {1}
    assert rows(mb.rank_term_table(docs, terms, max_bytes=0)) == got  # no filter, the same rows


def test_long_list_edges(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None), (4, "b  c"), (4, "b")], "doc_id long, text string")
    terms = spark.createDataFrame([("a",), ("b",), ("b",), ("",), (None,), ("zz",)], "term string")
    assert rows(mb.rank_term_table(docs, terms)) == [("b", 3), ("a", 1)]
    assert rows(mb.rank_term_table(docs, terms.limit(0))) == [] and rows(mb.rank_term_table(docs.limit(0), terms)) == []


POSTS = "ptype int, id bigint, accepted bigint, parent bigint, score int, tag string"


def test_bucketed_pairs_have_no_exchange(spark):
    data = [(1, q, None, None, 1, f"t{q}") for q in range(40)] + [(2, 100 + i, None, i % 50 if i % 3 else 7, i % 13 - 5, None) for i in range(400)]
    posts = spark.createDataFrame(data, POSTS)
    tables = bk.write_bucketed(posts, "unit_posts", scratch_path(spark, "bucketed"), buckets=4)
    pairs, best = bk.bucketed_pairs(spark, tables), bk.bucketed_best_score(spark, tables, floor=0)
    assert sorted(rows(pairs)) == sorted(rows(pr.pair_parent_child(posts)))
    assert sorted(rows(best)) == sorted(rows(pr.best_child_score(posts, floor=0)))
    assert "Exchange" not in plan(pairs) and "Exchange" not in plan(best)
    bad = spark.createDataFrame([(2, 1, None, None, 1, None)], POSTS)
    with pytest.raises(Exception):
        bk.write_bucketed(bad, "unit_bad", scratch_path(spark, "bucketed"), buckets=2)


def test_sql_functions_equal_the_columns(spark):
    register_sql(spark, "f_")
    nan = float("nan")
    values = [None, nan, 0.0, 1.0, 2.9, 3.0, 14.0, 15.0, 22.0, 23.0, 55.0, 56.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = df.select(working_band("v"), sex_band("v"), age_band("v"), minutes_to_hours("v")).collect()
    got = spark.sql("SELECT f_working_band(v), f_sex_band(v), f_age_band(v), f_minutes_to_hours(v) FROM {df}", df=df).collect()
    assert [str(tuple(r)) for r in got] == [str(tuple(r)) for r in want]
    docs = spark.createDataFrame([(1, "Java is C++, Java"), (2, ""), (3, None)], "doc_id long, text string")
    terms = ["Java", "C++", "is"]
    want = docs.select("doc_id", has_token("text", "Java").alias("h"), matching_terms("text", terms).alias("m"))
    sql = spark.sql("SELECT doc_id, f_has_token(text, 'Java') AS h, f_matching_terms(text, array('Java', 'C++', 'is')) AS m FROM {d}", d=docs)
    assert rows(sql) == rows(want)
    ranked = spark.sql("SELECT t.term, count(*) AS n FROM {d} d, LATERAL f_terms_of(d.text, array('Java', 'C++', 'is')) t GROUP BY ALL", d=docs)
    assert sorted(rows(ranked)) == sorted(rows(tm.rank_terms(docs, terms, keep_zero=False))) and "Python" not in plan(ranked)
    with pytest.raises(ValueError):
        register_sql(spark, "x; y")
