"""Mixing: targets against repeated resharing, quotas and bounds, the mixed texts, edge rows."""

import re
from collections import Counter, defaultdict

import pytest

from tessera.llm import mixing

SF = "/root/testdata/sf0.01"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def reshare(sizes):
    """Targets by repeated resharing, as the contract words it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        give = {s: left * weight[s] / total for s in free}
        left = 0.0
        for s, g in give.items():
            target[s] += g
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                free.discard(s)
    return target


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, rank int, row int")


def check(rows, got, near=0.02):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    want = reshare(sizes)
    assert Counter((d, size(t), sizes[s], round(want[s], 6)) for d, t, s in rows) == Counter(
        (r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    by = defaultdict(int)
    for r in got:
        by[(r.source_size, round(r.target, 6))] += r.taken
    alike = Counter((sizes[s], round(want[s], 6)) for s in sizes)
    for (z, t), n in by.items():
        assert abs(n - t * alike[z, t]) <= max(2 * mixing.BLOCK, near * t) * alike[z, t]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    got = mixing.report(docs).collect()
    check(rows, got)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.report(docs).collect()))


def test_hot_source_and_limits(spark):
    rows = [(i, "w " * (5 + i % 90), "big") for i in range(600)] + [(1000 + i, "x y z " * 30, f"s{i % 7}") for i in range(70)]
    got = mixing.report(frame(spark, rows)).collect()
    check(rows, got)


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t", "b"), (4, "one two three", None), (5, "word " * 30_000, "c"),
            (6, "x " * 500, "d"), (6, "x " * 500, "d"), (None, "n " * 300, "d"), (7, "nbsp is no blank", "é")]
    got = mixing.report(frame(spark, rows)).collect()
    check(rows, got, near=0.05)
    assert mixing.report(frame(spark, rows[:0])).collect() == []
    assert [r.taken for r in mixing.report(frame(spark, rows[:3])).collect()] == [0, 0, 0]
    assert mixing.apply(frame(spark, rows[:3])).collect() == []


def test_mixed_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    taken = {r.doc_id: r.taken for r in mixing.report(docs).collect()}
    out = mixing.apply(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    words = Counter()
    for r in out.collect():
        assert r.n_chars == len(r.text) and set(r.text.split()) <= set(texts[r.doc_id].split())
        words[r.doc_id] += size(r.text)
    assert {d: n for d, n in taken.items() if n} == dict(words)


def test_shards_draw_every_slot(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 64)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    m = mixing.mix(docs)
    counts = mixing.shard_counts(m).collect()
    quota = {r.source: r.slots for r in m.sources.collect()}
    by = Counter()
    for r in counts:
        by[r.source] += r.slots
    assert dict(by) == {s: n for s, n in quota.items() if n} and len({r.shard for r in counts}) > 5


def permutation(spark, n, seed, rank=1, turn=0):
    keys = f"transform(sequence(1, {mixing.ROUNDS}), r -> {mixing._hash(str(seed), str(rank), str(turn), 'r')})"
    df = spark.range(n).select("id", mixing.permuted("id", str(n), keys).alias("to"))
    return [r.to for r in df.orderBy("id").collect()]


@pytest.mark.parametrize("n", [1, 2, 3, 63, 1000, 5003])
def test_slots_permute_blocks(spark, n):
    for turn in (0, 1):
        assert sorted(permutation(spark, n, 11, turn=turn)) == list(range(n))


def test_permutation_is_keyed_and_mixed(spark):
    n = 4096
    a, b = permutation(spark, n, 11), permutation(spark, n, 12)
    assert a != b and a != permutation(spark, n, 11, rank=2) and a != permutation(spark, n, 11, turn=1)
    for p in (a, b):
        steps = Counter((y - x) % n for x, y in zip(p, p[1:], strict=False))
        assert max(steps.values()) < 12  # no shift or comb: steps hardly repeat
        low = sum(x < n // 2 for x in p[: n // 2])
        assert abs(low - n // 4) < 130  # of a random order: 4 deviations of 32
        assert sum(x == i for i, x in enumerate(p)) < 10


def test_permutation_matches_plain_python(spark):
    import hashlib

    n, p = 777, mixing.PRIME
    want = []
    for x in range(n):
        for r in range(1, mixing.ROUNDS + 1):
            k = int(hashlib.md5(f"11#1#0#{r}".encode()).hexdigest()[:13], 16)
            y = (k - x) % n
            u = (max(x, y) % p * mixing.FACTOR + max(x, y) // p + k % p) % p
            x = y if u * u % p // mixing.MIDDLE % 2 else x
        want.append(x)
    assert permutation(spark, n, 11) == want


def test_mixed_blocks_are_the_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 64)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = mixing.mixed_blocks(docs)
    assert out.columns == ["shard", "slot", "source", "block", "n_words", "text"]
    rows = out.collect()
    # Every source end to end, in blocks.
    by = defaultdict(list)
    for r in docs.select("doc_id", "source", "text").orderBy("doc_id").collect():
        by[r.source] += re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
    for r in rows:
        want = by[r.source][r.block * mixing.BLOCK:(r.block + 1) * mixing.BLOCK]
        assert r.text == " ".join(want) and r.n_words == len(want)
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r.slot)
    assert len(shards) > 5 and all(sorted(s) == list(range(len(s))) for s in shards.values())
    times = Counter((r.source, r.block) for r in rows)
    for source, words in by.items():
        got = [times[source, b] for b in range(-(-len(words) // mixing.BLOCK))]
        assert max(got) - min(got) <= 1  # none a second time before all once
    assert sum(r.taken for r in mixing.report(docs).collect()) == sum(r.n_words for r in rows)
    other = mixing.mixed_blocks(docs, seed=12).collect()
    assert {(r.shard, r.slot): (r.source, r.block) for r in rows} != {(r.shard, r.slot): (r.source, r.block) for r in other}
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mixed_blocks(docs).collect()), key=repr)


def test_repeated_rows_come_out_one_by_one(spark):
    rows = [(1, "a b c " * 40, "s")] * 50 + [(None, "d e " * 30, "s")] * 50 + [(2, None, "s"), (3, "", None)]
    docs = frame(spark, rows)
    taken = sum(r.taken for r in mixing.report(docs).collect())
    out = mixing.apply(docs).collect()
    assert sum(size(r.text) for r in out) == taken and max(size(r.text) for r in out) <= 120
    assert sum(r.n_words for r in mixing.mixed_blocks(docs).collect()) == taken
    assert mixing.mixed_blocks(frame(spark, rows[:0])).collect() == []


def test_no_python_on_the_executors(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (mixing.report(docs), mixing.apply(docs), mixing.mixed_blocks(docs)):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())
