"""Quality classifier: gradients, held-out accuracy, plain Python beside the query, edge rows."""

import math
import re
import struct
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import xxhash

from tessera.llm import quality
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
TEXT = "doc_id long, text string"


def test_repeated_words_have_a_feature_of_their_own():
    data = np.frombuffer(b"ab ab ab cd", dtype=np.uint8)
    doc, slot, count, words = quality._counts(data, np.array([0, len(data)]))
    # two words, one adjacent repeat, one token shape
    assert sorted(count.tolist()) == [1, 2, 3, 4] and (doc == 0).all() and words.tolist() == [4]


def test_ordered_grades_are_learned():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 4, 800)
    slots = [np.array(sorted({int(g), 10 + int(rng.integers(0, 50))}), dtype=np.int32) for g in grade]
    values = [np.ones(len(s), dtype=np.float32) for s in slots]
    m = quality.train(slots, values, grade, 4)
    s = [float((m.weights[a] * v).sum()) for a, v in zip(slots, values, strict=True)]
    assert (np.diff(m.thresholds) > 0).all()
    assert np.mean([np.searchsorted(m.thresholds, x) == g for x, g in zip(s, grade, strict=True)]) > 0.95


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = labels.filter("doc_id % 3 <> 0")
    out = {r.doc_id: r for r in quality.classify(docs, known).drop("text").collect()}
    held = labels.filter("doc_id % 3 = 0").collect()
    clean = [out[r.doc_id] for r in held if r.quality == 1 and r.toxic == 0]
    bad = [out[r.doc_id] for r in held if r.quality == 0 or r.toxic == 1]
    assert len(out) == docs.count() and len(clean) > 500 and len(bad) > 150
    assert sum(r.keep for r in clean) > 0.98 * len(clean)
    assert sum(not r.keep for r in bad) > 0.95 * len(bad)
    assert all(0 <= r.p_good <= 1 and 0 <= r.expected_grade <= 2 for r in clean + bad)


def test_edges(spark):
    good = [(i, f"a plain sentence number {i} with words") for i in range(60)]
    junk = [(100 + i, f"Buy!! now!! {i}!!") for i in range(60)]
    rows = [*good, *junk, (None, "a plain sentence with words"), (500, None), (501, ""), (502, "!!"),
            (503, "a plain sentence with words " * 20_000), (0, "a plain sentence number 0 with words")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], TEXT + ", keep int, slot string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in junk]
                                   + [(None, 1, 0), (1, None, 0), (2, 1, None), (9999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    out = quality.classify(docs, labels, least_docs=3)
    assert out.columns == ["doc_id", "text", "slot", "expected_grade", "p_good", "keep"]
    got = [(r.doc_id, r.keep) for r in out.collect()]
    assert len(got) == len(rows)
    assert all(k for d, k in got if d is not None and d < 60) and not any(k for d, k in got if d is not None and 100 <= d < 200)
    assert dict(got)[503] and dict(got)[None]
    assert quality.classify(docs.limit(0), labels).collect() == []
    prior = quality.classify(docs, labels.limit(0)).collect()
    assert len(prior) == len(rows) and not any(r.keep for r in prior)


def test_query(spark):
    got = QUERIES["op6_quality_classifier"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "expected_grade", "p_good", "keep"] and got.count() == 200


class Plain:
    """The classifier word by word in plain Python: features, sample, fit and scores."""

    M = (1 << 64) - 1

    @classmethod
    def mixed(cls, x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & cls.M
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & cls.M
        return x ^ (x >> 31)

    @classmethod
    def hashed(cls, raw):
        total, power = 0, 1
        for b in raw:
            total = (total + cls.mixed((b + 1) * 0xD1342543DE82EF95 & cls.M) * power) & cls.M
            power = power * 0x9E3779B97F4A7C15 & cls.M
        return cls.mixed((total + len(raw)) & cls.M)

    @staticmethod
    def shape(b):
        return 97 if 97 <= b < 123 or b >= 128 else 65 if 65 <= b < 91 else 48 if 48 <= b < 58 else b

    @classmethod
    def features(cls, text):
        """{slot: value} of a text."""
        raw = (text or "").encode()
        words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), raw))
        keys = [cls.hashed(w) for w in words]
        keys += [0xD0B1E for a, b in zip(words, words[1:], strict=False) if a == b]
        keys += [cls.hashed(w[:p]) ^ p for p in quality.PREFIXES for w in words if len(w) > p]
        tokens = re.findall(rb"[^\x20\x09-\x0D]+", raw)
        for t in tokens:
            s = 0
            for k in range(3):
                s = s * 256 + cls.shape(t[max(0, len(t) - 1 - k)])
            keys.append(cls.mixed(s * 256 + cls.shape(t[0]) + 0x5EED))
        n = max(1, len(words), len(tokens))
        return {k: math.log1p(100 * c / n) for k, c in sorted(Counter(k % quality.DIMENSIONS for k in keys).items())}

    @staticmethod
    def order(doc_id, grade):
        """Spark's xxhash64 of (long, int)."""
        first = xxhash.xxh64(struct.pack("<q", doc_id), seed=42).intdigest()
        h = xxhash.xxh64(struct.pack("<i", grade), seed=first).intdigest()
        return h - (1 << 64) if h >> 63 else h

    @staticmethod
    def sigmoid(x):
        return 1 / (1 + math.exp(-min(40, max(-40, x))))

    @classmethod
    def fit(cls, rated, grades=3, epochs=15, batch=64, rate=0.1, l2=3e-3, least_docs=6):
        """(weights, thresholds) of (grade, features) in order."""
        seen = [1 + sum(g == k for g, _ in rated) for k in range(grades)]
        cut = [math.log(sum(seen[:k + 1]) / (sum(seen) - sum(seen[:k + 1]))) for k in range(grades - 1)]
        held = Counter(s for _, f in rated for s in f)
        rated = [(g, {s: v for s, v in f.items() if held[s] >= least_docs}) for g, f in rated]
        balance = [(sum(seen) / n) ** 0.5 for n in seen]
        mean = sum(balance[g] for g, _ in rated) / len(rated)
        balance = [b / mean for b in balance]
        weights, square, square_cut = defaultdict(float), defaultdict(lambda: 1e-6), [1e-6] * (grades - 1)
        rng = np.random.default_rng(7)
        for _ in range(epochs):
            turn = rng.permutation(len(rated)).tolist()
            for lo in range(0, len(turn), batch):
                at = turn[lo:lo + batch]
                grad, grad_cut = defaultdict(float), [0.0] * (grades - 1)
                for i in at:
                    g, f = rated[i]
                    s = sum(weights[k] * v for k, v in f.items())
                    upper = cls.sigmoid(cut[g] - s) if g < grades - 1 else 1.0
                    lower = cls.sigmoid(cut[g - 1] - s) if g else 0.0
                    share = max(upper - lower, 1e-9)
                    for k, v in f.items():
                        grad[k] += (upper + lower - 1) * balance[g] * v / len(at)
                    if g < grades - 1:
                        grad_cut[g] += upper * (1 - upper) / share * balance[g] / len(at)
                    if g:
                        grad_cut[g - 1] -= lower * (1 - lower) / share * balance[g] / len(at)
                for k, d in grad.items():
                    d -= l2 * weights[k]
                    square[k] += d * d
                    weights[k] += rate * d / math.sqrt(square[k])
                for k, d in enumerate(grad_cut):
                    square_cut[k] += d * d
                    cut[k] += rate * d / math.sqrt(square_cut[k]) + k * 1e-6
                cut = list(accumulate(cut, max))
        return weights, cut


def test_query_matches_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    features = {d: Plain.features(t) for d, t in docs}
    grades = [(d, 0 if toxic else 1 if good == 0 else 2) for d, good, toxic in labels
              if d in features and good is not None and toxic is not None]
    grades.sort(key=lambda r: (Plain.order(*r), r[0]))
    assert len(grades) > 50
    weights, cut = Plain.fit([(g, features[d]) for d, g in grades])
    got = {r.doc_id: r for r in QUERIES["op6_quality_classifier"](spark, sf).collect()}
    assert sorted(got) == sorted(features)
    for d, f in features.items():
        s = sum(weights[k] * v for k, v in f.items())
        tail = [1 - Plain.sigmoid(c - s) for c in cut]
        assert abs(got[d].expected_grade - sum(tail)) < 0.01 and abs(got[d].p_good - tail[1]) < 0.01
        assert got[d].keep == (tail[1] >= 0.5) or abs(tail[1] - 0.5) < 0.01
