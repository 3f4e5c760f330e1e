"""Hard negatives, line bitmaps and importance scores against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reedbed.llm import hard_negatives, importance, line_dedup

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_features(text, ngrams=1, buckets=10_000):
    words = WORD.findall((text or "").translate(LOWER))
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, ngrams + 1) for i in range(len(words) - n + 1)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB9é中 .,_\x00\n😀Z"), max_size=40), min_size=1, max_size=5), st.integers(1, 3))
def test_features_equal_the_library_crc(texts, ngrams):
    counts, found = importance.features(texts, ngrams)
    for text, n, got in zip(texts, counts, found, strict=True):
        assert got.tolist() == brute_features(text, ngrams)
        assert n == len(brute_features(text))


def test_long_spans_fold():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcé") for _ in range(n)) for n in (1, 63, 64, 65, 127, 128, 129, 255, 256, 257, 1000, 100_000)]
    _, (got,) = importance.features([" ".join(words)], 2)
    assert got.tolist() == brute_features(" ".join(words), 2)


def test_lookups_in_parts(monkeypatch):
    monkeypatch.setattr(importance, "AT_ONCE", 50)
    text = "some words and one ofmanycharactersthatislongerthanapart " * 9
    assert importance.features([text, "", text])[1][2].tolist() == brute_features(text)


def brute_resample(docs, target, least_words=20, percent=10):
    s = Counter(b for _, t in docs for b in brute_features(t))
    t = Counter(b for x in target for b in brute_features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for key, text in docs:
        found = brute_features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10000.0) / ((s[b] + 1.0) * (all_t + 10000.0)))) for b in found)
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able):
        r.append(i + 1 if i < len(able) * percent // 100 else None)
    return sorted(map(str, (tuple((r + [None])[:5]) for r in rows)))


def test_resample(spark):
    rng = random.Random(5)
    vocabulary = ["alpha", "beta", "Gamma", "δ", "中文", "x1"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(150)]
    docs += [(150, None), (151, ""), (152, "..."), (None, "beta " * 40), (None, None), (7, docs[7][1]), (153, "long" * 9000 + " beta" * 5000)]
    target = ["alpha beta", None, "", "alpha alpha"]
    frame = spark.createDataFrame([(k, t, "x", 1, 2.0) for k, t in docs], "doc_id long, text string, key string, score int, `a.b` double").repartition(5)
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")
    names = ["doc_id", "n_features", "weight", "score", "rank"]
    got = importance.resample(frame, wanted).select(*names).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_resample(docs, target)
    nothing = importance.resample(frame.limit(0), wanted.limit(0))
    assert nothing.collect() == [] and nothing.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    alone = importance.resample(frame, wanted.limit(0), percent=100).select(*names).collect()
    assert sorted(str(tuple(r)) for r in alone) == brute_resample(docs, [], percent=100)


def brute_lines(docs, least=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    first = {}
    order = lambda k: (k is None, k or 0)
    for k, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                first[key(line)] = min(first.get(key(line), k), k, key=order)
    out = []
    for k, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or first[key(x)] == k]
        out.append(str((k, len(lines), len(lines) - len(kept), "\n".join(kept))))
    return sorted(out)


def line_rows(frame, **more):
    marked = line_dedup.line_bitmaps(frame, **more)
    return sorted(str(tuple(r)) for r in marked.select("doc_id", "n_lines", "n_dropped", line_dedup.kept_text(F.col("text"), F.col("keep"))).collect())


def test_line_bitmaps(spark):
    rng = random.Random(9)
    stock = ["A licence line of all", "a LICENCE line of all\t", "short", "", "  ", "naïve café ÉTÉ", "naïve café été", "\x0bTab and more \r", "ten chars!", "nine char", "x\x85padded line\x85"]
    docs = [(i, "\n".join(rng.choices(stock + [f"own line number {i}"], k=rng.randint(1, 9)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "\n" * 300 + "ten chars!\n" + "\n" * 200 + "A licence line of all"), (None, "only without an id\nTen Chars!"), (None, "only without an id"), (5, docs[5][1]), (5, "another row of five\nten chars!")]
    docs += [(63, "\n".join(f"line of a long text {i % 5000}" for i in range(20_000))), (64, "\n".join(f"line of a long text {i}" for i in range(0, 6000, 3)))]
    frame = spark.createDataFrame([(k, t, "x", 1, 0) for k, t in docs], "doc_id long, text string, doc string, h1 int, pos int").repartition(7)
    assert line_rows(frame) == brute_lines(docs)
    assert line_rows(frame, least_chars=1) == brute_lines(docs, 1)
    assert line_dedup.line_bitmaps(frame.limit(0)).collect() == []
    keep = {r.doc_id: r.keep for r in line_dedup.line_bitmaps(frame.where("doc_id IN (0, 60, 62)")).collect()}
    assert keep[60] is None


def test_frequent_lines_do_not_shuffle_and_windows_keep_the_ranges(spark):
    found = line_dedup.occurrences(line_dedup._keyed(spark.createDataFrame([(i, f"a line that all have\nline of its own {i}") for i in range(400)], "doc_id long, text string"), "doc_id", "text"))
    often = line_dedup.frequent(found).collect()
    assert [r["first"] for r in often] == [0]
    plan = line_dedup.repeats(found)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
    assert "Python" not in plan and "Arrow" not in plan


def brute_negatives(rows, every=50):
    best = lambda found: sorted(found, key=lambda x: (-x[0], x[1]))
    out = []
    for a, label, q in rows:
        if a % every:
            continue
        scored = [(int(np.dot(q, v)), i, other) for i, other, v in rows if i != a and len(v) == len(q)]
        for p, pid in [(s, i) for s, i, other in best(x for x in scored if x[2] == label)][:5]:
            fits = best(x for x in scored if x[2] != label and 50 * p <= 100 * x[0] <= 95 * p)
            out += [(a, pid, r + 1, i, p, s) for r, (s, i, _) in enumerate(fits[:3])]
    return sorted(out)


def test_hard_negatives(spark):
    rng = np.random.default_rng(4)
    groups = rng.normal(size=(6, 8))
    given_rows = [(i, (groups[i % 6] + rng.normal(size=8) * 0.5).round(3).tolist(), int(rng.integers(0, 3))) for i in range(900)]
    given_rows += [(900 + i, [0.5] * 8, i % 3) for i in range(60)] + [(1000, [0.0] * 8, 1), (1050, [1.0, 2.0], 1), (1051, [1.0, 2.5], 1), (1052, [1.0, 1.5], 2), (1100, [], 0), (1101, [], 0), (1102, [], 1)]
    odd = [(1150, None, 1), (1200, [1.0, None], 1), (1250, [float("nan")] * 8, 1), (1251, [float("inf")] * 8, 0), (None, [1.0] * 8, 1), (1300, [1.0] * 8, None)]
    repeated = [(950, [0.5] * 8, 950 % 3 + 0), given_rows[3], given_rows[50], given_rows[50]]
    frame = spark.createDataFrame([(*r, "x", 3, [1]) for r in given_rows + odd + repeated], "vec_id long, embedding array<float>, label int, id string, dim int, q array<int>")
    clean = {}
    for i, v, label in given_rows + repeated:
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        clean[i] = min(clean.get(i, (label, q)), (label, q))
    want = brute_negatives([(i, label, q) for i, (label, q) in clean.items()])
    assert want
    for rows in (8192, 100):
        got = hard_negatives.hard_negatives(frame, F.col("id") % 50 == 0, rows=rows)
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(tuple(r) for r in got.collect()) == want
    assert hard_negatives.hard_negatives(frame.limit(0), F.col("id") % 50 == 0).collect() == []


def test_walk_stops_early_and_is_exact():
    rng = np.random.default_rng(8)
    centre = rng.normal(size=16)
    rows = np.floor(256 * np.concatenate([centre + rng.normal(size=(400, 16)) * 0.2, rng.normal(size=(9000, 16)) * 0.3])).astype(np.int64)
    members = np.floor(256 * (centre + rng.normal(size=(20, 16)) * 0.05)).astype(np.int64)
    ids, labels = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    seen = []
    whole = hard_negatives.products

    def counted(one, two):
        seen.append(len(two))
        return whole(one, two)

    hard_negatives.products = counted
    try:
        of = np.arange(20)
        found = hard_negatives.walk([ids, labels, rows], [ids[:20] + 10**6, labels[:20], members], of, np.full(20, -(1 << 62)), np.full(20, 1 << 62), True, 5)
    finally:
        hard_negatives.products = whole
    assert sum(seen) < 2000
    scores = members @ rows.T
    for m in range(20):
        order = np.lexsort((ids, -scores[m]))[:5]
        assert found[2][found[0] == m].tolist() == order.tolist()


def test_products_beyond_doubles():
    big = np.array([[1 << 40, 3]]), np.array([[1 << 15, 1], [1 << 40, 1]])
    assert hard_negatives.products(*big).tolist() == [[(1 << 55) + 3, 1 << 62]]
