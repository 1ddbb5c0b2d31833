import os

import pytest

from conftest import rows
from tessera.operators import terms as tm
from tessera.operators import survey as sv
from tessera.plans import bindings as b
from tessera.streaming import read_stream, start, stream_survey_summary, stream_term_counts

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_stream_term_counts_equal_batch(spark, tmp_path):
    src = str(tmp_path / "docs")
    b.docs_frame(spark, SF).repartition(3).write.parquet(src)
    stream = read_stream(spark, src, max_files_per_trigger=1)
    q = start(stream_term_counts(stream, b.DOC_TERMS), output_mode="complete", sink="memory",
              query_name="term_counts_t", checkpoint=str(tmp_path / "ckpt"))
    q.processAllAvailable()
    q.stop()
    got = sorted(rows(spark.sql("SELECT term, n_docs FROM term_counts_t")))
    batch = sorted(rows(tm.rank_terms(spark.read.parquet(src), b.DOC_TERMS, keep_zero=False)))
    assert got == batch and got


def test_stream_survey_summary_equal_batch(spark, tmp_path):
    src = str(tmp_path / "survey")
    b.survey_frame(spark, SF).write.parquet(src)
    out = str(tmp_path / "out")
    q = start(stream_survey_summary(read_stream(spark, src)), output_mode="append", path=out,
              checkpoint=str(tmp_path / "ckpt2"), trigger_once=True)
    q.awaitTermination(120)
    got = sorted(rows(spark.read.parquet(out)))
    df = spark.read.parquet(src)
    p, w, o = sv.classify_columns(df.columns)
    assert got == sorted(rows(sv.summarize_time(df, p, w, o)))


def test_run_to_table_complete_over_several_batches(spark, tmp_path):
    from tessera.streaming import run_to_table
    src = str(tmp_path / "docs3")
    b.docs_frame(spark, SF).repartition(4).write.parquet(src)
    stream = read_stream(spark, src, max_files_per_trigger=1)
    got = sorted(rows(run_to_table(stream_term_counts(stream, b.DOC_TERMS), output_mode="complete",
                                   name="t-complete")))
    batch = sorted(rows(tm.rank_terms(spark.read.parquet(src), b.DOC_TERMS, keep_zero=False)))
    assert got == batch and got


def test_read_table_stream_reads_one_table(spark):
    from tessera.streaming import read_table_stream, run_to_table
    stream = read_table_stream(spark, SF, "documents")
    assert stream.isStreaming
    got = run_to_table(stream.select("doc_id"), output_mode="append", name="t-append")
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_state_partitions_apply_to_the_stream_only(spark, tmp_path):
    from tessera.streaming import run_to_table
    src = str(tmp_path / "docs4")
    b.docs_frame(spark, SF).repartition(2).write.parquet(src)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = run_to_table(stream_term_counts(read_stream(spark, src), b.DOC_TERMS), output_mode="complete",
                       name="t-state", state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    batch = sorted(rows(tm.rank_terms(spark.read.parquet(src), b.DOC_TERMS, keep_zero=False)))
    assert sorted(rows(got)) == batch


def test_table_of_part_files(spark, tmp_path):
    from tessera.plans import catalog
    for t, n in (("documents", 5), ("lineitem", 3)):
        spark.read.parquet(f"{SF}/{t}.parquet").repartition(n).write.parquet(f"{tmp_path}/{t}.parquet")
    for name in ("stream_term_counts", "stream_survey_summary"):
        whole = sorted(rows(catalog.QUERIES[name](spark, SF)))
        assert sorted(rows(catalog.QUERIES[name](spark, str(tmp_path)))) == whole
