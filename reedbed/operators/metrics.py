"""Classification metrics over recording predictions ``(y_true, y_pred, probs)``.

Label metrics start from the confusion counts, a table of classes x classes. Score
metrics start from positives and negatives per distinct ``(class, score)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reedbed.config import ClassMapping, EvaluationSettings
from reedbed.functions.columns import half_even, ratio, ratio_or_zero, species_of
from reedbed.functions.ordering import running_totals, value_cuts, with_next
from reedbed.operators.pooling import recording_predictions
from reedbed.session import materialize


def _pair_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("count"))


def confusion_counts(df: DataFrame) -> DataFrame:
    """True x predicted counts over every class that occurs on either side."""
    counts = _pair_counts(df)
    classes = F.array_distinct(F.concat(F.collect_set("y_true"), F.collect_set("y_pred")))
    grid = (
        counts.agg(classes.alias("_c"))
        .select("_c", F.explode("_c").alias("y_true"))
        .select("y_true", F.explode("_c").alias("y_pred"))
    )
    full = grid.join(counts, ["y_true", "y_pred"], "left")
    return full.select("y_true", "y_pred", F.coalesce("count", F.lit(0)).alias("count"))


def confusion_normalized(df: DataFrame) -> DataFrame:
    """Share of each true class; null for a class without true rows."""
    support = F.sum("count").over(Window.partitionBy("y_true"))
    return confusion_counts(df).select("y_true", "y_pred", ratio(F.col("count"), support).alias("share"))


def _class_counts(df: DataFrame) -> DataFrame:
    """tp, fp, fn per class that occurs in y_true or y_pred."""
    hit = F.col("y_true") == F.col("y_pred")
    n = F.col("count")
    sides = F.array(
        F.struct(F.col("y_true").alias("c"), F.when(hit, n).otherwise(0).alias("tp"), F.lit(0).cast("bigint").alias("fp"),
                 F.when(hit, 0).otherwise(n).alias("fn")),
        F.struct(F.col("y_pred").alias("c"), F.lit(0).cast("bigint").alias("tp"), F.when(hit, 0).otherwise(n).alias("fp"),
                 F.lit(0).cast("bigint").alias("fn")),
    )
    rows = _pair_counts(df).select(F.inline(sides).alias("class_label", "tp", "fp", "fn"))
    return rows.groupBy("class_label").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))


def _scores(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "class_label",
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("support"),
        "tp",
    )


def _labels_frame(df: DataFrame, mapping: ClassMapping) -> DataFrame:
    rows = [(i, s) for i, s in enumerate(mapping.species)]
    return df.sparkSession.createDataFrame(rows, "class_label int, species_name string")


def per_class_metrics(df: DataFrame, mapping: ClassMapping) -> DataFrame:
    """Precision, recall, f1, support of every mapped class; 0 where undefined."""
    joined = _labels_frame(df, mapping).join(_class_counts(df), "class_label", "left").na.fill(0, ["tp", "fp", "fn"])
    named = joined.select("class_label", "species_name")
    return named.join(_scores(joined).drop("tp"), "class_label").select(
        "class_label", "species_name", "precision", "recall", "f1", "support"
    )


def global_metrics(df: DataFrame) -> DataFrame:
    """Accuracy, macro and weighted averages over the classes in y_true or y_pred."""
    n = F.sum("support")
    return _scores(_class_counts(df)).agg(
        ratio(F.sum("tp"), n).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        ratio(F.sum(F.col("f1") * F.col("support")), n).alias("f1_weighted"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
    )


def classification_report(df: DataFrame, mapping: ClassMapping | None = None, digits: int = 3) -> DataFrame:
    """Per class rows, then accuracy, macro avg and weighted avg; values rounded half to even.

    As in a printed report turned into a table, the accuracy row repeats its value in all
    columns. ``is_summary`` tells the rows of averages; it and ``position`` order the rows.
    """
    scores = _scores(_class_counts(df))
    label = F.col("class_label").cast("string")
    if mapping is not None:
        label = F.coalesce(species_of(F.col("class_label"), mapping.species), label)
    n = F.sum("support")
    values = ["precision", "recall", "f1"]
    per_class = scores.select(
        F.lit(False).alias("is_summary"), F.col("class_label").cast("int").alias("position"), label.alias("label"), *values,
        F.col("support").cast("double"),
    )
    total = n.cast("double")
    sums = scores.agg(
        ratio(F.sum("tp"), n).alias("acc"),
        total.alias("n"),
        *[F.avg(v).alias(f"macro_{v}") for v in values],
        *[ratio(F.sum(F.col(v) * F.col("support")), n).alias(f"weighted_{v}") for v in values],
    )
    acc = F.col("acc")

    def row(position: int, name: str, cells: list[Column]) -> Column:
        named = [cell.alias(c) for c, cell in zip((*values, "support"), cells)]
        return F.struct(F.lit(True).alias("is_summary"), F.lit(position).alias("position"), F.lit(name).alias("label"), *named)

    rows = F.array(
        row(0, "accuracy", [acc] * 4),
        *[
            row(1 + i, f"{kind} avg", [*[F.col(f"{kind}_{v}") for v in values], F.col("n")])
            for i, kind in enumerate(("macro", "weighted"))
        ],
    )
    summary = sums.select(F.inline(rows))
    both = per_class.unionByName(summary)
    rounded = [half_even(F.col(c), digits).alias(c) for c in (*values, "support")]
    return both.select("is_summary", "position", "label", *rounded).orderBy("is_summary", "position")


def classes_by_f1(report: DataFrame) -> DataFrame:
    """Class rows of a report by f1 descending, ties by label."""
    return report.filter(~F.col("is_summary")).orderBy(F.col("f1").desc(), "label")


def one_vs_rest(df: DataFrame) -> DataFrame:
    """One row per prediction and class: ``class_label, score, is_true``."""
    return df.select("y_true", F.posexplode("probs").alias("class_label", "score")).select(
        "class_label", "score", (F.col("class_label") == F.col("y_true")).alias("is_true")
    )


def drop_unseen_classes(df: DataFrame, long_rows: DataFrame) -> DataFrame:
    """Rows of ``long_rows`` whose ``class_label`` occurs as a true class in ``df``."""
    seen = df.select(F.col("y_true").alias("class_label")).distinct()
    return long_rows.join(seen, "class_label", "left_semi")


def _score_points(df: DataFrame) -> DataFrame:
    """Per (class, score), best first: positives and negatives here, so far, and in all."""
    scores = one_vs_rest(df)
    points = scores.groupBy("class_label", "score").agg(
        F.count_if("is_true").alias("pos"), F.count_if(~F.col("is_true")).alias("neg")
    )
    return running_totals(points, ["class_label"], "score", ["pos", "neg"], value_cuts(scores, "score"), descending=True)


def _roc_auc(points: DataFrame) -> DataFrame:
    above = F.col("pos_run") - F.col("pos")
    wins = F.sum(F.col("neg").cast("double") * (above.cast("double") + F.col("pos") / F.lit(2.0)))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total").cast("double")
    return points.groupBy("class_label").agg(ratio(wins, pairs).alias("roc_auc"))


def _average_precision(points: DataFrame) -> DataFrame:
    precision = ratio(F.col("pos_run"), F.col("pos_run") + F.col("neg_run"))
    area = F.sum(F.col("pos") * precision)
    return points.groupBy("class_label").agg(ratio(area, F.max("pos_total")).alias("pr_auc"))


def _mean_or_null(per_class: DataFrame, col: str, out: str) -> DataFrame:
    all_known = F.count(col) == F.count(F.lit(1))
    return per_class.agg(F.when(all_known, F.avg(col)).alias(out))


def _curve(points: DataFrame, x: str, y: str, cols: dict[str, Column], start: dict[str, float]) -> DataFrame:
    """Curve of the classes with true rows; each class also gets its point before the first threshold (null)."""
    seen = points.filter("pos_total > 0")
    curve = seen.select("class_label", F.col("score").alias("threshold"), *[cols[c].alias(c) for c in (x, y)])
    first = seen.select("class_label").distinct().select(
        "class_label", F.lit(None).cast("double").alias("threshold"), *[F.lit(start[c]).alias(c) for c in (x, y)]
    )
    return curve.unionByName(first)


def _parallel(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Whether two steps of (positives, negatives) go in one direction: exact, as products of counts may pass 64 bits."""
    (a_pos, a_neg), (b_pos, b_neg) = ([F.col(c).cast("decimal(19,0)") for c in step] for step in (a, b))
    return a_pos * b_neg == b_pos * a_neg


def _with_next_step(points: DataFrame) -> DataFrame:
    return with_next(points, ["class_label"], "score", ["pos", "neg"], value_cuts(points, "score"), descending=True)


def _roc_corners(points: DataFrame) -> DataFrame:
    """The points where the curve turns, and each class's last one."""
    straight = _parallel(("pos", "neg"), ("pos_next", "neg_next"))
    return _with_next_step(points).filter(F.col("pos_next").isNull() | ~straight)


def _pr_corners(points: DataFrame) -> DataFrame:
    """All but the points inside a vertical (recall stays) or level (precision stays) stretch of the curve."""
    vertical = (F.col("pos") == 0) & (F.col("pos_next") == 0)
    is_first = (F.col("pos_run") == F.col("pos")) & (F.col("neg_run") == F.col("neg"))
    # The point before the first threshold has precision 1.
    level_in = F.when(is_first, F.col("neg_run") == 0).otherwise(_parallel(("pos", "neg"), ("pos_run", "neg_run")))
    level_out = _parallel(("pos_next", "neg_next"), ("pos_run", "neg_run"))
    return _with_next_step(points).filter(F.col("pos_next").isNull() | ~(vertical | (level_in & level_out)))


def _roc_curve(points: DataFrame, thin: bool = False) -> DataFrame:
    rates = {
        "fpr": ratio(F.col("neg_run"), F.col("neg_total")),
        "tpr": ratio(F.col("pos_run"), F.col("pos_total")),
    }
    return _curve(_roc_corners(points) if thin else points, "fpr", "tpr", rates, {"fpr": 0.0, "tpr": 0.0})


def _pr_curve(points: DataFrame, thin: bool = False) -> DataFrame:
    rates = {
        "precision": ratio(F.col("pos_run"), F.col("pos_run") + F.col("neg_run")),
        "recall": ratio(F.col("pos_run"), F.col("pos_total")),
    }
    return _curve(_pr_corners(points) if thin else points, "precision", "recall", rates, {"precision": 1.0, "recall": 0.0})


def _pr_trapezoid(points: DataFrame) -> DataFrame:
    # The point before follows from the running sums, so no row looks at its neighbour.
    pos_before = F.col("pos_run") - F.col("pos")
    neg_before = F.col("neg_run") - F.col("neg")
    here = ratio(F.col("pos_run"), F.col("pos_run") + F.col("neg_run"))
    before = F.coalesce(ratio(pos_before, pos_before + neg_before), F.lit(1.0))
    area = F.sum(F.col("pos") * (here + before) / 2)
    seen = points.filter("pos_total > 0")
    return seen.groupBy("class_label").agg(ratio(area, F.max("pos_total")).alias("pr_auc_trapezoid"))


def roc_auc_per_class(df: DataFrame) -> DataFrame:
    """One-vs-rest AUC by counting ordered pairs, half for ties; null for a one-sided class."""
    return _roc_auc(_score_points(df))


def roc_auc_macro(df: DataFrame) -> DataFrame:
    """Mean AUC; null as soon as one class has none."""
    return _mean_or_null(roc_auc_per_class(df), "roc_auc", "roc_auc_macro")


def average_precision_per_class(df: DataFrame) -> DataFrame:
    """Sum of precision times the step in recall; null without positives."""
    return _average_precision(_score_points(df))


def average_precision_macro(df: DataFrame) -> DataFrame:
    return _mean_or_null(average_precision_per_class(df), "pr_auc", "pr_auc_macro")


def roc_curve(df: DataFrame, thin: bool = False) -> DataFrame:
    """``(threshold, fpr, tpr)`` at every distinct score of the classes with true rows, and the origin.

    ``thin`` leaves out the points on the line between their neighbours; the area stays the same.
    """
    return _roc_curve(_score_points(df), thin)


def pr_curve(df: DataFrame, thin: bool = False) -> DataFrame:
    """``(threshold, precision, recall)`` likewise; the extra point is recall 0, precision 1.

    ``thin`` leaves out the points inside vertical or level stretches; the trapezoid area stays the same.
    """
    return _pr_curve(_score_points(df), thin)


def pr_auc_trapezoid(df: DataFrame) -> DataFrame:
    """Trapezoid area below the precision-recall curve; not the same as average precision."""
    return _pr_trapezoid(_score_points(df))


def top_k_accuracy(df: DataFrame, k: int = 3) -> DataFrame:
    """Share of rows whose true class has fewer than ``k`` more probable classes."""

    def in_top() -> Column:
        own = F.col("probs")[F.col("y_true")]
        return F.size(F.filter("probs", lambda p: p > own)) < k

    return df.agg(F.avg(in_top().cast("int")).alias("top_k_accuracy"))


def evaluate(chunks: DataFrame, mapping: ClassMapping, settings: EvaluationSettings) -> dict[str, DataFrame]:
    """Pool chunks and compute all metric frames.

    The pooled frame and its score points are written once and shared by the frames.
    """
    pooled = materialize(
        recording_predictions(
            chunks, mapping, settings.n_classes, settings.pooling, settings.k, settings.confidence_threshold, settings.legacy_eval
        ),
        "pooled",
    )
    points = materialize(_score_points(pooled), "score-points")
    roc_auc, average_precision = _roc_auc(points), _average_precision(points)
    return {
        "recording_predictions": pooled,
        "confusion_counts": confusion_counts(pooled),
        "confusion_normalized": confusion_normalized(pooled),
        "per_class_metrics": per_class_metrics(pooled, mapping),
        "global_metrics": global_metrics(pooled),
        "classification_report": classification_report(pooled, mapping),
        "roc_auc_per_class": roc_auc,
        "roc_auc_macro": _mean_or_null(roc_auc, "roc_auc", "roc_auc_macro"),
        "average_precision_per_class": average_precision,
        "average_precision_macro": _mean_or_null(average_precision, "pr_auc", "pr_auc_macro"),
        "roc_curve": _roc_curve(points),
        "pr_curve": _pr_curve(points),
        "pr_auc_trapezoid": _pr_trapezoid(points),
        "top_k_accuracy": top_k_accuracy(pooled, settings.k),
    }
