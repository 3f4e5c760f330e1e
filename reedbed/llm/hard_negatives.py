"""Hard negatives of anchor vectors by shared lists: exact inner products with certified stops.

Anchors of similar direction form a cluster. For each cluster and block of candidates the candidates are sorted
once by the most that any member could score with them: the candidate's length times the cosine of its
angle to the cluster's centre less the cluster's own opening. Every member walks this list from its
head and stops where that bound is below the least score it still needs, so what it did not see cannot count.

Blocks of candidates are shuffled once and anchors, of which there are far fewer, are sent to each of them. A
task holds one block of candidates and one of anchors at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reedbed.llm.common import column, materialize

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
#: Rows of a block of candidates, members of a block of anchors, and candidates that a walk reads at a time.
ROWS, MEMBERS, STEP = 8192, 256, 512
#: Clusters are fitted on so many anchors at most, and there are so many at most. They only sort the work.
SAMPLE, CLUSTERS = 4096, 64
#: Scaled components beyond this count as this.
MOST = 1 << 52
_FAR = 1 << 62


def vectors(table: DataFrame, key: str, label: str | Column, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, label, q): the rows with all of these and finite components only, scaled and rounded down.

    Rows with the same id are one: that of the least label, then vector.
    """
    values = column(vector)
    whole = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(values, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(MOST))), F.lit(-float(MOST)))))
    kind = column(label) if isinstance(label, str) else label
    rows = table.select(column(key).cast("long").alias("id"), kind.cast("long").alias("label"), F.when(whole, scaled).alias("q")).dropna()
    return rows.groupBy("id").agg(F.min(F.struct("label", "q")).alias("row")).select("id", "row.label", "row.q")


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    lengths = np.sqrt((rows * rows).sum(axis=-1, keepdims=True))
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


def fit_centres(sample: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spread first centres."""
    units = _unit(sample)
    centres = units[np.linspace(0, len(units) - 1, clusters).astype(int)]
    for _ in range(rounds):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        centres = np.where((sums != 0).any(axis=1, keepdims=True), _unit(sums), centres)
    return centres


def _rows_of(held: pa.ListScalar, dim: int) -> list[np.ndarray]:
    """Ids, labels and vectors of a packed block, and what else it holds."""
    fields = held.values
    ids, labels = (fields.field(i).to_numpy(zero_copy_only=False) for i in range(2))
    return [ids, labels, fields.field(2).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)]


def products(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """All inner products as exact integers; those beyond 62 bits count as that."""
    most = one.shape[1] * int(np.abs(one).max(initial=0)) * int(np.abs(two).max(initial=0))
    if most < 1 << 53:
        return (one.astype(np.float64) @ two.astype(np.float64).T).astype(np.int64)
    found = one.astype(object) @ two.astype(object).T
    return np.clip(found, -_FAR, _FAR).astype(np.int64)


def first_of(lists: np.ndarray, scores: np.ndarray, ids: np.ndarray, most: int) -> list[np.ndarray]:
    """The first ``most`` of each list by higher score, then smaller id."""
    order = np.lexsort((ids, -scores, lists))
    lists, scores, ids = lists[order], scores[order], ids[order]
    new = np.append(True, lists[1:] != lists[:-1])[: len(lists)]
    start = np.maximum.accumulate(np.where(new, np.arange(len(lists)), 0))
    keep = np.arange(len(lists)) - start < most
    return [lists[keep], scores[keep], ids[keep]]


def bounds(candidates: np.ndarray, members: np.ndarray) -> np.ndarray:
    """For each candidate, the most that a member of length one could score with it."""
    units = _unit(members)
    centre = _unit(units.sum(axis=0))
    opening = np.arccos(np.clip(units @ centre, -1, 1)).max(initial=0)
    lengths = np.sqrt((candidates.astype(np.float64) ** 2).sum(axis=1))
    angle = np.arccos(np.clip(_unit(candidates) @ centre, -1, 1))
    return lengths * (np.cos(np.maximum(angle - opening - 1e-7, 0)) + 1e-8)


def walk(candidates: list[np.ndarray], members: list[np.ndarray], of: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, most: int) -> list[np.ndarray]:
    """For each list, of member ``of``, the first ``most`` candidates that score from ``low`` to ``high``: list, score, id.

    Candidates are those of the member's label, itself left out, or those of other labels.
    """
    ids, labels, rows = candidates
    own_ids, own_labels, own = members
    bound = bounds(rows, own)
    order = np.argsort(-bound, kind="stable")
    lengths = np.sqrt((own.astype(np.float64) ** 2).sum(axis=1))
    found, need = [np.zeros(0, np.int64)] * 3, low.copy()
    going = np.flatnonzero(low <= high)
    for at in range(0, len(order), STEP):
        # A list goes on while what is ahead may still reach the score it needs.
        going = going[lengths[of[going]] * bound[order[at]] + 1e-6 >= need[going]]
        if not len(going):
            break
        part = order[at : at + STEP]
        walking, row = np.unique(of[going], return_inverse=True)
        scores = products(own[walking], rows[part])
        fits = own_labels[walking][:, None] == labels[part]
        fits = fits & (own_ids[walking][:, None] != ids[part]) if same else ~fits
        each = scores[row]
        line, col = np.nonzero(fits[row] & (each >= need[going][:, None]) & (each <= high[going][:, None]))
        if len(line):
            more = [going[line], each[line, col], ids[part][col]]
            found = first_of(*(np.concatenate(pair) for pair in zip(found, more)), most)
            last = np.flatnonzero(np.append(found[0][1:] != found[0][:-1], True))
            full = np.bincount(found[0], minlength=len(need))[found[0][last]] == most
            need[found[0][last][full]] = found[1][last][full]
    return found


def _packed(rows: DataFrame, groups: list[str], fields: list[str]) -> DataFrame:
    return rows.groupBy("dim", *groups).agg(F.collect_list(F.struct(*fields)).alias("held"))


def _clustered(anchors: DataFrame, fields: list[str]) -> DataFrame:
    """Anchors in blocks of one cluster: (dim, cluster, slice, held)."""
    sample: dict[int, list] = {}
    for r in anchors.select("id", "dim", "q").orderBy(F.xxhash64("id")).limit(SAMPLE).collect():
        sample.setdefault(r["dim"], []).append(r["q"])
    centres = {d: fit_centres(np.array(q, np.int64).reshape(len(q), d), min(CLUSTERS, -(-len(q) // 64))) for d, q in sample.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest = []
            for q in batch.column("q").to_pylist():
                known = centres.get(len(q))
                nearest.append(int((known @ _unit(np.array(q, np.float64))).argmax()) if known is not None else 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(nearest, pa.int64())], ["id", "cluster"])

    placed = materialize(anchors.select("id", "q").mapInArrow(assign, "id long, cluster long").join(anchors, "id"), "clustered")
    sizes = placed.groupBy("dim", "cluster").agg(F.ceil(F.count("*") / MEMBERS).alias("slices"))
    sliced = placed.join(sizes, ["dim", "cluster"]).withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")))
    return _packed(sliced, ["cluster", "slice"], fields)


def _met(blocks: DataFrame, anchors: DataFrame, n_blocks: int) -> DataFrame:
    """Each block of candidates with each block of anchors of as many components."""
    tasks = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * n_blocks)
    sent = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn("block", F.col("block").cast("long"))
    one = blocks.repartition(tasks, "dim", "block").withColumnRenamed("held", "candidates")
    return one.join(sent.repartition(tasks, "dim", "block"), ["dim", "block"]).select("dim", "block", "candidates", "held")


def _walked(met: DataFrame, same: bool, most: int, low: int, high: int) -> DataFrame:
    """The first of each block for each anchor (``same``) or for each anchor and positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, candidates = None, []
        for batch in batches:
            for dim, block, packed, held in zip(*(batch.column(c) for c in ("dim", "block", "candidates", "held"))):
                d = dim.as_py()
                if at != (d, block.as_py()):
                    at, candidates = (d, block.as_py()), _rows_of(packed, d)
                members = _rows_of(held, d)
                if same:
                    of = np.arange(len(members[0]))
                    positive = score = np.zeros(len(of), np.int64)
                    least, top = np.full(len(of), -_FAR), np.full(len(of), _FAR)
                else:
                    lists = held.values.field(3)
                    of = np.repeat(np.arange(len(members[0])), lists.value_lengths().to_numpy(zero_copy_only=False))
                    score, positive = (lists.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(2))
                    least = np.array([-(-int(s) * low // 100) for s in score], np.int64)
                    top = np.array([int(s) * high // 100 for s in score], np.int64)
                which, scores, ids = walk(candidates, members, of, least, top, same, most)
                columns = [members[0][of[which]], positive[which], score[which], scores, ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "positive_id", "positive_score", "score", "id"])

    return met.mapInArrow(run, "anchor_id long, positive_id long, positive_score long, score long, id long")


def _first(found: DataFrame, groups: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    table: DataFrame, anchor: Column, key: str = "vec_id", label: str | Column = "label", vector: str = "embedding", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, rows: int = ROWS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``anchor`` is a condition on ``id`` that picks the anchors. An anchor's positives are the ``positives`` other rows of
    its label with the highest inner products, its negatives for one of them the first ``negatives`` rows of other
    labels that score from ``low`` to ``high`` percent of the positive's score; ties go to the smaller id. All rows
    are candidates, and the result is exact.

    Rows without an id or label, with a null vector, or a null or non-finite component take no part; rows of the same id
    count once. Vectors of different length have no score with each other; empty ones score 0. A positive with a
    negative score has no negatives. Ids and labels are integers. Other columns are not carried.
    """
    every = materialize(vectors(table, key, label, vector, scale).withColumn("dim", F.size("q")), "vectors")
    n_blocks = max(1, -(-every.count() // rows))
    blocks = materialize(_packed(every.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks))), ["block"], ["id", "label", "q"]), "blocks")
    anchors = every.where(anchor)
    near = _walked(_met(blocks, _clustered(anchors, ["id", "label", "q"]), n_blocks), True, positives, low, high)
    near = materialize(_first(near, ["anchor_id"], positives).select(F.col("anchor_id").alias("id"), F.struct("score", F.col("id").alias("positive_id")).alias("one")), "positives")
    paired = anchors.join(near.groupBy("id").agg(F.collect_list("one").alias("positives")), "id")
    far = _walked(_met(blocks, _clustered(materialize(paired, "paired"), ["id", "label", "q", "positives"]), n_blocks), False, negatives, low, high)
    ranked = _first(far, ["anchor_id", "positive_id"], negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
