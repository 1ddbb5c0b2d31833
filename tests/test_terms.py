import random

import pytest

from conftest import rows
from tessera.operators import terms as tm


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(pairs)], "doc_id long, title string, text string")


# Own documents: crates of fruit by their labels.
THREE = [("a", "Quince jam keeps, like Medlar jelly, for years"),
         ("b", "Pear and Quince ripen in October"),
         ("c", "Pear trees outlive gardeners")]
FIVE = THREE + [("d", "Bees visit Damson blossom before Quince"),
                ("e", "Quince needs a warm wall")]
NAMES = ["Pear", "Quince", "Medlar", "Damson", "Bees", "Mango"]


def test_mention_count(spark):
    d = docs(spark, [("x", "Pear Pearmain")])
    assert rows(tm.mention_count(d, "Pear")) == [("Pear", 1)]
    for bad in ("", None):
        with pytest.raises((ValueError, TypeError)):
            tm.mention_count(d, bad)


@pytest.mark.parametrize("text", ["Pear, Plum", "Pearmain apples", "pear lower", "Pear\tPlum", ""])
def test_token_rules_no_match(spark, text):
    d = docs(spark, [("t", text)])
    assert rows(tm.mention_count(d, "Pear")) == [("Pear", 0)]


def test_repeated_token_counts_once(spark):
    d = docs(spark, [("t", "Pear Pear"), ("u", "x Pear")])
    assert rows(tm.rank_terms(d, ["Pear"])) == [("Pear", 2)]


def test_rank_terms_keep_zero(spark):
    d = docs(spark, [("p", "Plum tart"), ("q", "Pear pie, never Plum pie")])
    assert rows(tm.rank_terms(d, ["Plum", "Pear", "Mango"])) == [("Plum", 2), ("Pear", 1), ("Mango", 0)]


def test_rank_ties_keep_list_order(spark):
    got = rows(tm.rank_terms(docs(spark, FIVE), NAMES))
    assert got == [("Quince", 4), ("Pear", 2), ("Medlar", 1), ("Damson", 1), ("Bees", 1), ("Mango", 0)]


def test_build_index(spark):
    idx = tm.build_index(docs(spark, THREE), ["Pear", "Quince"], carry=("title",))
    assert sorted(rows(idx)) == [("Pear", 1, "b"), ("Pear", 2, "c"), ("Quince", 0, "a"), ("Quince", 1, "b")]


def test_rank_from_index_and_fused_agree(spark):
    d = docs(spark, FIVE)
    a = rows(tm.rank_from_index(tm.build_index(d, NAMES)))
    b = rows(tm.rank_terms(d, NAMES, keep_zero=False))
    assert a == b == [("Quince", 4), ("Pear", 2), ("Bees", 1), ("Damson", 1), ("Medlar", 1)]
    assert sorted(r for r in rows(tm.rank_terms(d, NAMES)) if r[1] > 0) == sorted(a)


def test_term_table_join_gives_the_same(spark):
    d = docs(spark, FIVE)
    assert rows(tm.rank_terms(d, NAMES, by_join=True)) == rows(tm.rank_terms(d, NAMES))
    assert sorted(rows(tm.build_index(d, NAMES, by_join=True))) == sorted(rows(tm.build_index(d, NAMES)))
    many = [f"no{i}" for i in range(3000)] + NAMES
    assert rows(tm.rank_terms(d, many, by_join=True, keep_zero=False)) == rows(tm.rank_terms(d, NAMES, keep_zero=False))


def test_rankings_force_no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for by_join in (False, True):
            plan = tm.rank_terms(docs(spark, FIVE), NAMES, by_join=by_join)._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_column_named_doc_ids_is_only_data(spark):
    flat = spark.createDataFrame([("Pear", [1, 2, 3]), ("Pear", [4])], "term string, doc_ids array<int>")
    assert rows(tm.rank_from_index(flat)) == [("Pear", 2)]
    assert rows(tm.rank_from_index(flat, pages=True)) == [("Pear", 4)]


def test_pages_of_ids_beyond_doubles(spark):
    ids = [2**53, 2**53 + 1, -1, -2, 0]
    d = spark.createDataFrame([(i, "Pear") for i in ids], "doc_id long, text string")
    got = sorted(rows(tm.build_index_pages(d, ["Pear"], page_size=1)))
    assert got == [("Pear", i, [i]) for i in sorted(ids)]
    assert sorted(rows(tm.build_index_pages(d, ["Pear"], page_size=2)))[0] == ("Pear", -1, [-2, -1])


def test_duplicate_terms_rejected(spark):
    with pytest.raises(ValueError):
        tm.rank_terms(docs(spark, THREE), ["Pear", "Pear"])


def test_empty_term_rejected(spark):
    with pytest.raises(ValueError):
        tm.rank_terms(docs(spark, THREE), ["Pear", ""])


def test_plan_one_scan_no_python(spark, tmp_path):
    p = str(tmp_path / "docs")
    docs(spark, FIVE).write.parquet(p)
    d = spark.read.parquet(p)
    plan = tm.rank_terms(d, ["Pear", "Quince"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "Python" not in plan and "BatchEvalPython" not in plan


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_docs_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    vocab = ["Java", "java", "Java,", "JavaScript", "Scala", "", "C#", "the", "a"]
    seps = [" ", " ", " ", "\t", "  "]
    texts = []
    for _ in range(300):
        n = rnd.randint(0, 12)
        toks = [rnd.choice(vocab) for _ in range(n)]
        texts.append("".join(t + rnd.choice(seps) for t in toks).rstrip(rnd.choice(["", " "])))
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    terms = ["Java", "Scala", "C#", "the", "JavaScript", "zzz"]
    hits = {t: sorted(i for i, x in enumerate(texts) if t in x.split(" ")) for t in terms}
    expect = sorted(((t, len(ids)) for t, ids in hits.items()), key=lambda p: -p[1])
    expect = sorted(expect, key=lambda p: (-p[1], terms.index(p[0])))
    assert rows(tm.rank_terms(d, terms)) == expect
    assert sorted(rows(tm.build_index(d, terms))) == sorted((t, i) for t, ids in hits.items() for i in ids)
    fused = rows(tm.rank_terms(d, terms, keep_zero=False))
    assert fused == sorted(((t, n) for t, n in expect if n), key=lambda p: (-p[1], p[0]))
    assert rows(tm.mention_count(d, "Java")) == [("Java", len(hits["Java"]))]


def test_index_pages_bounded_and_complete(spark):
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice(["Java", "Scala", "x", "y"]) for _ in range(rnd.randint(1, 6))) for _ in range(500)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    pages = tm.build_index_pages(d, ["Java", "Scala", "zzz"], page_size=37)
    got = rows(pages)
    assert all(len(ids) <= 37 and ids == sorted(ids) for _, _, ids in got)
    assert all(all(i // 37 == p for i in ids) for _, p, ids in got)
    flat = sorted((t, i) for t, _, ids in got for i in ids)
    assert flat == sorted(rows(tm.build_index(d, ["Java", "Scala", "zzz"])))
    assert rows(tm.rank_from_index(pages, pages=True)) == rows(tm.rank_from_index(tm.build_index(d, ["Java", "Scala", "zzz"])))


def test_index_pages_need_integer_ids(spark):
    d = spark.createDataFrame([("a", "Java")], "doc_id string, text string")
    with pytest.raises(TypeError):
        tm.build_index_pages(d, ["Java"])
