"""Decontamination against plain Python, removal of documents and spans, edge rows."""

import hashlib
import re

from tessera.llm import decontaminate as dc

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, n=10):
    grams = {}
    for i, t in items:
        ws = words(t)
        w = min(n, len(ws))
        for k in range(len(ws) - w + 1 if ws else 0):
            grams.setdefault(tuple(ws[k:k + w]), set()).update({i} - {None})
    out = []
    for d, t in rows:
        ws, hit, found = words(t), set(), set()
        for w in {len(g) for g in grams}:
            for k in range(len(ws) - w + 1):
                g = tuple(ws[k:k + w])
                if g in grams:
                    hit |= set(range(k, k + w))
                    found |= {str(i) for i in grams[g]}
        out.append((d, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "One two three four five six seven eight nine ten ELEVEN twelve"), (2, "short item here"), (10, "short item here"),
         (3, None), (4, "!!!"), (None, "an item without an id"), (5, "ünï çödé 中文 wörds"), (1, "One two three four five six seven eight nine ten ELEVEN twelve")]
LONG = " ".join(f"f{i}" for i in range(20_000))
ROWS = [(1, "x one, two three-four FIVE six seven eight nine ten y"), (2, "one two three four five six seven eight nine"),
        (3, "a short item here short ITEM here."), (4, None), (5, ""), (6, LONG + " short item here " + LONG), (None, "short item here"),
        (7, "Has an item without an id!"), (8, "ünï çödé 中文 wörds"), (8, "ünï çödé 中文 wörds"), (8, "other text"),
        (9, "one two three four five six seven eight nine ten eleven twelve"), (10, "ÜNÏ çödé 中文 wörds")]


def frames(spark, rows=ROWS, items=ITEMS):
    return (spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, h int, gram string"),
            spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, w int"))


def test_matches_brute_force(spark):
    docs, bench = frames(spark)
    got = sorted((tuple(r) for r in dc.report(docs, bench).collect()), key=str)
    assert got == brute(ROWS, ITEMS)


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_BYTES", 0)
    docs, bench = frames(spark)
    got = sorted((tuple(r) for r in dc.report(docs, bench).collect()), key=str)
    assert got == brute(ROWS, ITEMS)


def test_no_python_on_the_executors(spark):
    docs, bench = frames(spark)
    plan = dc.report(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search("Python|Arrow|Pandas", plan)


def test_empty_tables(spark):
    docs, bench = frames(spark)
    assert dc.report(docs.limit(0), bench).collect() == []
    assert [r.n_hit for r in dc.report(docs, bench.limit(0)).collect()] == [0] * len(ROWS)


def test_removal(spark):
    docs, bench = frames(spark)
    kept = dc.remove_documents(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(2, ROWS[1][1]), (4, ""), (5, ""), (8, "other text"), (10, ROWS[-1][1])]
    cut = {(r.doc_id, r.text) for r in dc.remove_spans(docs, bench).collect()}
    assert (1, "x y") in cut and (3, "a ") in cut and (4, None) in cut and (7, "Has ") in cut and (2, ROWS[1][1]) in cut
    assert not any(words(t)[:1] == ["short"] for _, t in cut)
