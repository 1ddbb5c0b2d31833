"""Blocks of large clusters keep a fixed size, and rounds of block pairs give the links of all pairs."""

from pyspark.sql import functions as F
from test_ngram_join import brute, run

from tessera.llm import ngram_join


def test_blocks_keep_their_size(spark):
    df = spark.createDataFrame([(1, 300), (16_384, 5_000_000), (1_000_000, 300_000_000), (3_000_000_000, 10 ** 12), (200, 6_000_000)],
                               "members long, tokens long")
    for m, t, b in df.select("members", "tokens", ngram_join.block_count(F.col("members"), F.col("tokens"))).collect():
        assert b >= 1 and m / b <= ngram_join.MOST and t / b <= ngram_join.TOKENS
    assert [r[0] for r in df.select(ngram_join.block_count(F.col("members"), F.col("tokens"))).collect()[:2]] == [1, 128]


def test_rounds_take_every_pair_of_blocks_once(spark):
    sets = spark.createDataFrame([(7, b, 1, b, 10, b"") for b in range(10)], "root long, node long, size long, block int, blocks int, tokens binary")
    for rounds in (1, 3, 4, 30):
        got = [tuple(r) for k in range(rounds) for r in ngram_join._place(sets, k, rounds).select("i", "j", "node").collect()]
        assert sorted(got) == sorted({(min(i, j), max(i, j), i) for i in range(10) for j in range(10)})


def test_no_pair_of_blocks_grows_with_its_cluster(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 2)
    monkeypatch.setattr(ngram_join, "MOST", 6, raising=False)
    monkeypatch.setattr(ngram_join, "FOLD", 4, raising=False)
    link, largest = ngram_join._link_blocks, 20

    def watched(threshold):
        compute = link(threshold)

        def checked(batches):
            from collections import Counter

            batches = list(batches)
            seen = Counter(k for b in batches for k in zip(*(b.column(c).to_pylist() for c in ("root", "i", "j")), strict=True))
            assert max(seen.values(), default=0) <= largest, seen
            return compute(iter(batches))

        return checked

    monkeypatch.setattr(ngram_join, "_link_blocks", watched)
    rows = [(i, " ".join(f"w{k}" if k != i else f"x{i}" for k in range(60))) for i in range(60)]
    rows += [(100 + i, " ".join(f"w{k}" for k in range(60))) for i in range(7)]
    rows += [(200 + i, " ".join(f"u{i}_{k}" for k in range(50))) for i in range(3)]
    assert run(spark, rows, leaf=4) == brute(rows)
