"""Sharding against a plain-Python minimax partition; atomic groups, slots, written shards, edge rows."""

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import sharding as sh
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def least_capacity(sizes, shards):
    def shards_needed(c):
        n, room = 0, 0
        for s in sizes:
            if s > c:
                return shards + 1
            if s > room:
                n, room = n + 1, c
            room -= s
        return n
    low, high = 0, sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if shards_needed(mid) <= shards else (mid + 1, high)
    return low


def check(rows, got, shards=16):
    """The laws: all rows, groups together and contiguous, the least possible largest shard, gapless slots in order."""
    groups = {}
    for d, t in rows:
        key = hashlib.md5((t or "").encode()).digest()
        first, size, n = groups.get(key, (None, 0, 0))
        groups[key] = (d if first is None else first if d is None else min(first, d), size + len((t or "").encode()) + 1, n + 1)
    order = sorted(groups, key=lambda k: (groups[k][0] is None, groups[k][0] or 0, k))
    crc = {zlib.crc32((t or "").encode()): hashlib.md5((t or "").encode()).digest() for _, t in rows}
    assert sorted((str(r.doc_id), r.text_crc32) for r in got) == sorted((str(d), zlib.crc32((t or "").encode())) for d, t in rows)
    place = {}
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        assert place.setdefault(crc[r.text_crc32], r.shard) == r.shard
    along = [place[k] for k in order]
    assert along == sorted(along)
    loads, slots = {}, {}
    for r in got:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append((r.slot, order.index(crc[r.text_crc32]), r.doc_id is None, r.doc_id or 0))
    for s in slots.values():
        s.sort()
        assert [x[0] for x in s] == list(range(len(s)))
        assert [x[1:] for x in s] == sorted(x[1:] for x in s)
    if rows:
        assert max(loads.values()) <= least_capacity([groups[k][1] for k in order], shards)
        assert len(loads) == min(shards, len(groups)) or max(loads.values()) > sum(loads.values()) / shards


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, shard string, place int, row int")
    return sh.assign(df, **options).collect()


def test_query_keeps_the_laws(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_sharding"](spark, SF)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = got.collect()
    check(rows, got)
    assert got == sorted(got, key=got.index) and {r.shard for r in got} == set(range(16))


def test_runs_are_split_down_to_groups(spark, monkeypatch):
    monkeypatch.setattr(sh, "FANOUT", 3)
    monkeypatch.setattr(sh, "AT_ONCE", 2)
    rows = [(i, "x" * (7 * i % 50) + str(i)) for i in range(600)]
    for shards in (1, 2, 7, 16):
        check(rows, run(spark, rows, shards=shards), shards)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=60), st.integers(1, 9), st.integers(1, 12), st.integers(2, 5))
def test_search_is_exact(sizes, shards, run_length, fanout):
    class Split(sh._Runs):
        def __init__(self):
            self.rows = [(i, len(sizes[i:i + run_length]), sum(sizes[i:i + run_length]), max(sizes[i:i + run_length]))
                         for i in range(0, len(sizes), run_length)]
            self._add_up()

        def split(self, which):
            assert which
            for i in sorted(which, reverse=True):
                first, n, *_ = self.rows[i]
                assert n > 1
                step = -(-n // fanout)
                self.rows[i:i + 1] = [(j, len(c), sum(c), max(c)) for j in range(first, first + n, step)
                                      for c in [sizes[j:min(j + step, first + n)]]]
            self._add_up()

    runs = Split()
    capacity = runs.capacity(shards)
    assert capacity == least_capacity(sizes, shards)
    cuts = [0, *runs.cuts(capacity, shards), sum(sizes)]
    assert cuts == sorted(cuts) and max(b - a for a, b in zip(cuts[:-1], cuts[1:], strict=True)) <= capacity
    ends = {sum(sizes[:i]) for i in range(len(sizes) + 1)}
    assert set(cuts) <= ends
    starts = [runs.place(c) for c in cuts[:-1]]
    assert all(s is None or sum(sizes[:s]) == c for s, c in zip(starts, cuts, strict=False))


def test_a_hot_group_and_null_ids(spark):
    rows = [(i if i % 3 else None, "hot" * 40) for i in range(400)] + [(None, f"t{i} " * (i % 17)) for i in range(500)] + [(7, "same id"), (7, "other")]
    check(rows, run(spark, rows))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, None), (2, ""), (None, None), (3, "a")], [(1, "é" * 50000), (2, "b"), (2, "b")]])
def test_edges(spark, rows):
    check(rows, run(spark, rows))


def test_written_shards_hold_whole_rows(spark, tmp_path):
    df = spark.createDataFrame([(i, "w " * (i % 9), i * 2) for i in range(200)], "doc_id long, text string, shard int")
    sh.write(df, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(tuple(r.doc) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    assert back.select("shard").distinct().count() == 4
