"""Pooling and metrics against plain Python over all rows, ties and one-sided classes included."""

import math
import random
from fractions import Fraction

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reedbed.config import OTHER, ClassMapping, EvaluationSettings
from reedbed.operators import metrics, pooling

MAPPING = ClassMapping((OTHER, "a", "b", "c"))
CHUNK = "recording_id int, chunk_index int, probs array<double>, y_true int"


def made(seed=3, hot=60):
    """Chunks of unequal recordings, one of which holds a third of all; coarse scores give ties."""
    rng = random.Random(seed)
    out = []
    for rec, n in enumerate([hot] + [rng.randint(1, 6) for _ in range(35)]):
        label = rng.randint(0, 2)
        for chunk in range(n):
            raw = [rng.randint(1, 4) for _ in range(4)]
            out.append((rec, chunk * 2, [x / sum(raw) for x in raw], label))
    rng.shuffle(out)
    return out


def grouped(data):
    out = {}
    for rec, chunk, probs, label in sorted(data):
        out.setdefault(rec, []).append((probs, label))
    return out


def amax(p):
    return p.index(max(p))


def mean(vectors, weights=None):
    weights = weights or [1.0] * len(vectors)
    return [sum(w * v[i] for w, v in zip(weights, vectors)) / sum(weights) for i in range(len(vectors[0]))]


def expected(strategy, vectors, k=3):
    if strategy == "max":
        return max(vectors, key=max)  # the first of equals
    if strategy == "topk":
        return mean(sorted(vectors, key=lambda v: -max(v))[:k])
    if strategy == "softmax":
        return mean(vectors, [math.exp(max(v)) for v in vectors])
    return mean(vectors)


@pytest.mark.parametrize("strategy", list(pooling.POOLING))
def test_pooling(spark, strategy):
    data = made()
    got = {r["recording_id"]: r for r in pooling.pool(spark.createDataFrame(data, CHUNK), strategy, 4).collect()}
    assert len(got) == len(grouped(data))
    for rec, chunks in grouped(data).items():
        vectors = [p for p, _ in chunks]
        want = expected(strategy, vectors)
        row = got[rec]
        assert row["probs"] == pytest.approx(want) and row["num_chunks"] == len(chunks) and row["y_true"] == chunks[0][1]
        if strategy == "voting":
            votes = [amax(v) for v in vectors]
            winner = max(dict.fromkeys(votes), key=votes.count)  # the first seen of equals
            assert row["y_pred"] == winner
            assert row["confidence"] == pytest.approx(want[winner])
        else:
            assert row["confidence"] == pytest.approx(max(want))
            assert want[row["y_pred"]] == pytest.approx(max(want))


def test_argmax_takes_the_lowest_class_on_ties(spark):
    df = spark.createDataFrame([(1, 0, [0.4, 0.4, 0.1, 0.1], 0)], CHUNK)
    assert pooling.chunk_argmax(df).first()["y_pred"] == 0


def test_max_and_votes_go_by_chunk_order(spark):
    data = [(1, 5, [0.1, 0.7, 0.1, 0.1], 0), (1, 2, [0.7, 0.1, 0.1, 0.1], 0)]
    df = spark.createDataFrame(data, CHUNK)
    assert pooling.pool_max(df, 4).first()["y_pred"] == 0
    assert pooling.pool_voting(df, 4).first()["y_pred"] == 0
    assert pooling.pool_topk(df, 4, 9).first()["num_chunks"] == 2


def test_optimistic_label_is_off_unless_asked_for(spark):
    data = [(1, 0, [0.9, 0.1, 0.0, 0.0], 2), (1, 1, [0.3, 0.1, 0.6, 0.0], 2), (2, 1, [0.0, 1.0, 0.0, 0.0], 3), (2, 0, [0.6, 0.4, 0.0, 0.0], 3)]
    df = spark.createDataFrame(data, CHUNK)
    assert rows(pooling.pool_mean(df, 4), "recording_id", "y_pred") == [(1, 0), (2, 1)]
    assert rows(pooling.eval_override(df, 4), "recording_id", "y_pred") == [(1, 2), (2, 0)]
    legacy = pooling.recording_predictions(df, MAPPING, 4, legacy_eval=True)
    assert rows(legacy, "predicted_species", "true_species") == [(OTHER, "c"), ("b", "b")]
    plain = pooling.recording_predictions(df, MAPPING, 4)
    assert rows(plain, "recording_id", "predicted_class") == [(1, 0), (2, 1)]


def test_threshold_marks_every_recording(spark):
    data = [(1, 0, [0.4, 0.3, 0.2, 0.1]), (2, 0, [0.0, 1.0, 0.0, 0.0])]
    df = spark.createDataFrame(data, "recording_id int, chunk_index int, probs array<double>")
    got = pooling.recording_predictions(df, MAPPING, 4, threshold=0.5)
    assert rows(got, "recording_id", "predicted_species", "predicted_class") == [(1, "LOW_CONFIDENCE", -1), (2, "a", 1)]
    assert got.filter("recording_id = 2").first()["prob_by_species"] == {OTHER: 0.0, "a": 1.0, "b": 0.0, "c": 0.0}
    short = pooling.recording_predictions(df, ClassMapping((OTHER,)), 4).filter("recording_id = 2").first()
    assert short["predicted_species"] == "Unknown_1" and "class_3" in short["prob_by_species"]
    with pytest.raises(ValueError):
        pooling.pool(df, "median", 4)


# --- metrics ---------------------------------------------------------------------------

PRED = "y_true int, y_pred int, probs array<double>"


def predictions(seed=5, n=120):
    """Class 3 is never true, class 0 never predicted first; coarse scores tie often."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        raw = [rng.randint(1, 3), rng.randint(2, 5), rng.randint(2, 5), rng.randint(1, 5)]
        probs = [x / sum(raw) for x in raw]
        out.append((rng.choice([0, 1, 1, 1, 2]), amax(probs), probs))
    return out


@pytest.fixture(scope="module")
def scored(spark):
    data = predictions()
    return data, spark.createDataFrame(data, PRED).cache()


def by_class(df, col):
    return {r["class_label"]: r[col] for r in df.collect()}


def points(data, c):
    """(threshold, tp, fp) at every distinct score, best first."""
    return [
        (s, sum(p[c] >= s and t == c for t, _, p in data), sum(p[c] >= s and t != c for t, _, p in data))
        for s in sorted({p[c] for _, _, p in data}, reverse=True)
    ]


def test_confusion_covers_all_classes_of_either_side(spark, scored):
    data, df = scored
    got = {(r["y_true"], r["y_pred"]): r["count"] for r in metrics.confusion_counts(df).collect()}
    classes = {t for t, _, _ in data} | {p for _, p, _ in data}
    assert got == {(t, p): sum((a, b) == (t, p) for a, b, _ in data) for t in classes for p in classes}
    assert sum(got.values()) == len(data)
    shares = {(r["y_true"], r["y_pred"]): r["share"] for r in metrics.confusion_normalized(df).collect()}
    assert shares[3, 1] is None
    assert sum(v for (t, _), v in shares.items() if t == 1) == pytest.approx(1)


def label_scores(data, c):
    tp = sum(t == c == p for t, p, _ in data)
    predicted, support = sum(p == c for _, p, _ in data), sum(t == c for t, _, _ in data)
    precision, recall = (tp / predicted if predicted else 0), (tp / support if support else 0)
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0
    return precision, recall, f1, support


def test_label_metrics(spark, scored):
    data, df = scored
    wide = ClassMapping((*MAPPING.species, "never"))
    for row in metrics.per_class_metrics(df, wide).collect():
        want = label_scores(data, row["class_label"])
        assert (row["precision"], row["recall"], row["f1"], row["support"]) == pytest.approx(want)
    assert metrics.per_class_metrics(df, wide).count() == 5
    present = sorted({t for t, _, _ in data} | {p for _, p, _ in data})
    table = [label_scores(data, c) for c in present]
    got = metrics.global_metrics(df).first()
    assert got["accuracy"] == pytest.approx(sum(t == p for t, p, _ in data) / len(data))
    assert got["f1_macro"] == pytest.approx(sum(x[2] for x in table) / len(table))
    assert got["f1_weighted"] == pytest.approx(sum(x[2] * x[3] for x in table) / len(data))
    assert got["precision_macro"] == pytest.approx(sum(x[0] for x in table) / len(table))
    assert got["recall_macro"] == pytest.approx(sum(x[1] for x in table) / len(table))
    report = metrics.classification_report(df, MAPPING)
    labels = [r["label"] for r in report.collect()]
    assert labels == [MAPPING.species[c] for c in present] + ["accuracy", "macro avg", "weighted avg"]
    ordered = metrics.classes_by_f1(report).collect()
    assert [r["f1"] for r in ordered] == sorted((r["f1"] for r in ordered), reverse=True) and len(ordered) == len(present)


@pytest.mark.parametrize("pieces", ["1", "3", "16"])
def test_score_metrics(spark, scored, pieces):
    data, df = scored
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", pieces)
    try:
        auc, ap = by_class(metrics.roc_auc_per_class(df), "roc_auc"), by_class(metrics.average_precision_per_class(df), "pr_auc")
        area = by_class(metrics.pr_auc_trapezoid(df), "pr_auc_trapezoid")
        roc = [tuple(r) for r in metrics.roc_curve(df).collect()]
        pr = [tuple(r) for r in metrics.pr_curve(df).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert auc[3] is None and ap[3] is None and 3 not in area
    for c in (0, 1, 2):
        pos, neg = [p[c] for t, _, p in data if t == c], [p[c] for t, _, p in data if t != c]
        wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
        assert auc[c] == pytest.approx(wins / len(pos) / len(neg))
        curve = points(data, c)
        xy = [(tp / len(pos), tp / (tp + fp)) for _, tp, fp in curve]
        steps = list(zip([(0.0, 1.0)] + xy, xy))
        assert ap[c] == pytest.approx(sum((b[0] - a[0]) * b[1] for a, b in steps)) and 0 <= ap[c] <= 1
        assert area[c] == pytest.approx(sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in steps))
        mine = sorted((r[1], r[3], r[2]) for r in roc if r[0] == c and r[1] is not None)
        want = sorted((s, tp / len(pos), fp / len(neg)) for s, tp, fp in curve)
        assert sum(mine, ()) == pytest.approx(sum(want, ()))
        assert (c, None, 0.0, 0.0) in roc and (c, None, 1.0, 0.0) in pr
        assert sorted(r[1] for r in pr if r[0] == c and r[1] is not None) == pytest.approx(sorted(s for s, _, _ in curve))


def thinned(curve, on_line):
    """Points of a curve, one after the other, without those that lie between their neighbours."""
    kept = curve[:1]
    for here, following in zip(curve[1:], curve[2:] + [None]):
        if following is None or not on_line(kept[-1], here, following):
            kept.append(here)
    return kept


@pytest.mark.parametrize("pieces", ["1", "5"])
def test_thin_curves_keep_their_corners(spark, pieces):
    rng = random.Random(3)
    # Runs of hits and of misses, equal scores among them, and a class that is always right.
    data = [(int(rng.random() < i % 90 / 90), 0, [1 - (i // 2) / 200, (i // 2) / 200]) for i in range(300)] + [(2, 0, [0.1, 0.2])]
    data = [(t, p, scores + [1.0 if t == 2 else 0.0]) for t, p, scores in data]
    df = spark.createDataFrame(data, PRED)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", pieces)
    try:
        roc, pr = ([tuple(r) for r in fn(df, thin=True).collect()] for fn in (metrics.roc_curve, metrics.pr_curve))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

    def cross(a, b, c):
        return (b[1] - a[1]) * (c[2] - b[2]) == (b[2] - a[2]) * (c[1] - b[1])

    for c in (0, 1, 2):
        all_points = [(None, Fraction(0), Fraction(0))] + [(s, Fraction(tp), Fraction(fp)) for s, tp, fp in points(data, c)]
        want = thinned(all_points, cross)
        pos, neg = sum(t == c for t, _, _ in data), sum(t != c for t, _, _ in data)
        assert c == 2 or len(want) < len(all_points)
        mine = sorted((r[1], r[3], r[2]) for r in roc if r[0] == c and r[1] is not None)
        assert sum(mine, ()) == pytest.approx(sum(sorted((s, float(tp) / pos, float(fp) / neg) for s, tp, fp in want[1:]), ()))
        level = [(None, Fraction(0), Fraction(1))] + [(s, tp, tp / (tp + fp)) for s, tp, fp in all_points[1:]]
        straight = lambda a, b, d: a[1] == b[1] == d[1] or a[2] == b[2] == d[2]
        whole = lambda line: sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(line, line[1:]))
        want = thinned(level, straight)
        assert whole(want) == whole(level)
        got = sorted((r[1], r[3], r[2]) for r in pr if r[0] == c and r[1] is not None)
        assert sum(got, ()) == pytest.approx(sum(sorted((s, float(tp) / pos, float(p)) for s, tp, p in want[1:]), ()))


def test_macro_is_unknown_when_a_class_is(spark, scored):
    _, df = scored
    assert metrics.roc_auc_macro(df).first()[0] is None and metrics.average_precision_macro(df).first()[0] is None
    both = spark.createDataFrame([(0, 0, [0.9, 0.1]), (1, 1, [0.2, 0.8]), (1, 0, [0.5, 0.5])], PRED)
    assert metrics.roc_auc_macro(both).first()[0] == 1.0


def test_equal_scores_give_half_an_auc(spark):
    df = spark.createDataFrame([(0, 0, [0.5, 0.5]), (1, 0, [0.5, 0.5]), (1, 0, [0.5, 0.5])], PRED)
    assert by_class(metrics.roc_auc_per_class(df), "roc_auc") == {0: 0.5, 1: 0.5}
    assert by_class(metrics.average_precision_per_class(df), "pr_auc") == pytest.approx({0: 1 / 3, 1: 2 / 3})


def test_auc_does_not_change_under_monotone_scores(spark, scored):
    _, df = scored
    squared = df.withColumn("probs", F.transform("probs", lambda p: p * p * p + 1))
    assert by_class(metrics.roc_auc_per_class(squared), "roc_auc") == by_class(metrics.roc_auc_per_class(df), "roc_auc")


def test_top_k_and_unseen_classes(spark, scored):
    data, df = scored
    want = sum(sum(x > p[t] for x in p) < 2 for t, _, p in data) / len(data)
    assert metrics.top_k_accuracy(df, 2).first()[0] == pytest.approx(want)
    assert {r[0] for r in metrics.drop_unseen_classes(df, metrics.one_vs_rest(df)).select("class_label").distinct().collect()} == {0, 1, 2}


def test_evaluate_returns_all_frames(spark):
    chunks = spark.createDataFrame(made(), CHUNK)
    frames = metrics.evaluate(chunks, MAPPING, EvaluationSettings(n_classes=4, pooling="voting"))
    assert frames["recording_predictions"].count() == 36
    assert frames["confusion_counts"].agg(F.sum("count")).first()[0] == 36
    pooled = pooling.pool_voting(chunks, 4)
    for name, fn, col in (("roc_auc_per_class", metrics.roc_auc_per_class, "roc_auc"),
                          ("average_precision_per_class", metrics.average_precision_per_class, "pr_auc")):
        assert by_class(frames[name], col) == pytest.approx(by_class(fn(pooled), col))
