"""The corpus pipeline, stage by stage against plain Python, on documents made for it and on a given table."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_decontaminate import brute as contaminated
from test_mixing import reshare, size
from test_ngram_join import brute as groups
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as cp

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SF = "/root/testdata/sf0.01"


def expected_ids(rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = Counter()
    for d, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out[(d, len(ids), zlib.crc32(ids.tobytes()))] += 1
    return out


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        df = cp.stored(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, df))
        docs = df
    return {name: (before, after) for name, before, after in out}


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_are_named_in_order():
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "ngram_jaccard_join", "decontamination", "mixing", "token_ids"]
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()


def test_columns(stages):
    for name, (_, after) in stages.items():
        assert after.columns == (COLUMNS if name != "token_ids" else ["doc_id", "start", "n_tokens", "ids_crc32"])


def test_classifier_keeps_good_documents(spark, stages):
    before, after = stages["quality_classifier"]
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    clean = [r.doc_id in kept for r in labels if r.quality == 1 and r.toxic == 0]
    bad = [r.doc_id in kept for r in labels if r.quality == 0 or r.toxic == 1]
    assert np.mean(clean) > 0.97 and np.mean(bad) < 0.1
    assert set(pairs(after)) <= set(pairs(before))


def test_one_document_of_each_group_stays(stages):
    before, after = stages["ngram_jaccard_join"]
    rows = pairs(before)
    least = {d for d, c, _ in groups(rows) if d == c}
    assert sorted(pairs(after)) == sorted((d, t) for d, t in rows if d in least)


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = pairs(before)
    hit = {r[0] for r in contaminated(rows, items) if r[-1]}
    assert hit and sorted(pairs(after)) == sorted((d, t) for d, t in rows if d not in hit)


def test_mix_meets_its_targets(stages):
    before, after = stages["mixing"]
    sizes, taken = Counter(), Counter()
    for r in before.collect():
        sizes[r.source] += size(r.text)
    for r in after.collect():
        taken[r.source] += size(r.text)
        assert r.n_chars == len(r.text)
    for s, t in reshare(sizes).items():
        assert abs(taken[s] - t) <= 128
    whole = {r.doc_id: Counter(r.text.split()) for r in before.collect()}
    assert all(Counter(r.text.split()) <= whole[r.doc_id] for r in after.collect())


def test_files_hold_the_mixed_texts(stages):
    before, after = stages["token_ids"]
    rows = sorted((tuple(r) for r in after.collect()), key=lambda r: r[1])
    assert Counter((d, n, c) for d, _, n, c in rows) == expected_ids(pairs(before))
    assert [r[0] for r in rows] == sorted(r[0] for r in rows)
    assert [r[1] for r in rows] == np.concatenate([[0], np.cumsum([r[2] for r in rows])[:-1]]).tolist()


def test_run_equals_its_stages(spark, stages):
    got = sorted(tuple(r) for r in cp.run(spark, SF).collect())
    assert got == sorted(tuple(r) for r in stages["token_ids"][1].collect())


def test_edge_rows_pass_every_stage(spark, tmp_path):
    good = "a plain sentence of words number {} with its own text {} and {}"
    rows = [(i, good.format(i, i * 7, i * 13), "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(None, good.format("x", "y", "z"), None, None, None), (41, None, "en", "s1", 0), (42, "", "en", None, 0),
             (43, good.format(1, 2, 3) * 3000, "en", "s2", 5), (1, good.format(1, 7, 13), "en", "s1", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(41, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, good.format(5, 35, 65)), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], schema + ", node int, _id string, keep string")
    for empty in (False, True):
        df = docs.limit(0) if empty else docs
        for name, stage in cp.STAGES:
            if name == "quality_classifier":
                assert stage(spark, df, str(tmp_path)).columns == docs.columns
                continue
            df = cp.stored(stage(spark, df, str(tmp_path)), f"edge-{name}")
            assert name == "token_ids" or df.columns == docs.columns
        assert (df.count() == 0) == empty
