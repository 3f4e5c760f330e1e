"""Near-duplicates by word shingles, MinHash bands and odd sketches.

Equal shingle sets form one class. Each class is sampled by MinHash; samples in bands of four make
buckets, and all samples folded into a bitmap by parity make an odd sketch, whose XOR with another
tells how many samples differ. Candidates are pairs within a bucket; those whose sketches are alike are
confirmed on the full sets, and linked classes form components.

No bucket is expanded into pairs. First each member meets one pivot of the bucket only, then the member
with the most in common with all others. What is in one component needs no more links; only members of
one bucket that are still in different components meet, in blocks: sketch by sketch, each pair in the first bucket
that holds both, and at once on the full sets. Two blocks send the links that join components, no others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from reedbed.llm.common import keyed_text, materialize, parted, text_batches
from reedbed.llm.components import components
from reedbed.session import bound_batches

WORDS, PERCENT = 5, 75
#: MinHash samples in bands: a pair at 75 % meets in no bucket with probability (1 - 0.75 ** 4) ** 32 = 5e-6.
BANDS, BAND_ROWS = 32, 4
SAMPLES = BANDS * BAND_ROWS
#: Bits of an odd sketch, as 64-bit words; and by how much an estimate may fall short. At most 100 bits may then differ, which a pair at 75 %
#: exceeds with probability 2.2e-7 (computed exactly), less than the bands lose (5.2e-6).
SKETCH_WORDS, MARGIN = 8, 0.25
SKETCH_BITS = 64 * SKETCH_WORDS
#: Members of a bucket that one task compares with as many others at a time, and about how many shingles they have.
BLOCK, BLOCK_SHINGLES = 512, 500_000
#: Shingles whose members are counted in one product of matrices.
COLUMNS = 4096
#: Buckets of more than one part in so many, for each shuffle partition, of all rows are joined without a shuffle.
PARTS = 4

_rng = np.random.default_rng(20240229)
_FACTORS, _SHIFTS = _rng.integers(0, 1 << 64, SAMPLES, np.uint64) | np.uint64(1), _rng.integers(0, 1 << 64, SAMPLES, np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordIds(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = number = xxhash.xxh3_64_intdigest(word)
        return number


_ids = _WordIds()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit digests.

    Words are runs of other than ASCII white space with A-Z in lower case. A text of fewer words is one shingle,
    one without words has none.
    """
    found = text.encode().lower().split()
    n, width = len(found), min(words, len(found))
    if not n:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(_ids.__getitem__, found), np.uint64, n)
    rolled = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        rolled = _mixed(rolled * np.uint64(0xD6E8FEB86659FD93) + ids[k : n - width + 1 + k])
    return np.unique(rolled)


def linked(one: int, two: int, common: int, percent: int = PERCENT) -> bool:
    """Whether two sets of these sizes with so many elements in common are alike enough."""
    return common > 0 and 100 * common >= percent * (one + two - common)


def samples(shingle_set: np.ndarray) -> np.ndarray:
    """The least of each of the hash functions over a set that is not empty."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingle_set), 1024):
        least = np.minimum(least, (shingle_set[at : at + 1024, None] * _FACTORS + _SHIFTS).min(axis=0))
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """The bucket of each band, as signed 64-bit numbers."""
    rolled = np.arange(BANDS, dtype=np.uint64)
    for k in range(BAND_ROWS):
        rolled = _mixed(rolled * _MIX + least.reshape(BANDS, BAND_ROWS)[:, k])
    return rolled.view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """The parity of the samples that fall on each bit."""
    at = _mixed(least + np.arange(SAMPLES, dtype=np.uint64) * _MIX) % np.uint64(SKETCH_BITS)
    odd = np.bincount(at.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_bits(similarity: float) -> int:
    """Bits that differ between the sketches of two sets of this similarity, on average."""
    return int(SKETCH_BITS / 2 * (1 - math.exp(-2 * 2 * SAMPLES * (1 - similarity) / SKETCH_BITS)))


def estimate(one: np.ndarray, two: np.ndarray) -> float:
    """The similarity that two odd sketches tell."""
    share = 2 * int(np.bitwise_count((one ^ two).view(np.uint64)).sum()) / SKETCH_BITS
    return 1 + SKETCH_BITS / (4 * SAMPLES) * math.log(1 - share) if share < 1 else 0.0


def _sketched(docs: DataFrame) -> DataFrame:
    """(key, text) to (key, size, node, buckets, sketch); ``node`` is the digest of the set, null for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for keys, texts in text_batches(batches):
            size, node, buckets, sketch = [], [], [], []
            for text in texts:
                found = shingles(text)
                size.append(len(found))
                if not len(found):
                    for out in (node, buckets, sketch):
                        out.append(None)
                    continue
                least = samples(found)
                node.append(_node(found))
                buckets.append(bands(least))
                sketch.append(odd_sketch(least))
            columns = [pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(buckets, longs), pa.array(sketch, longs)]
            yield pa.RecordBatch.from_arrays([keys, *columns], ["key", "size", "node", "buckets", "sketch"])

    many = ArrayType(LongType())
    fields = [("size", LongType()), ("node", LongType()), ("buckets", many), ("sketch", many)]
    return docs.mapInArrow(run, StructType([docs.schema["key"], *(StructField(*f) for f in fields)]))


def _node(shingle_set: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingle_set.tobytes()) - (1 << 63)


def _alike(one: str, two: str, percent: int) -> Column:
    """Whether sizes and sketches of two sides allow a link."""
    bits = sum((F.bit_count(F.col(f"{one}.sketch")[k].bitwiseXOR(F.col(f"{two}.sketch")[k])) for k in range(SKETCH_WORDS)), F.lit(0))
    small, large = (f(F.col(f"{one}.size"), F.col(f"{two}.size")) for f in (F.least, F.greatest))
    return (100 * small >= percent * large) & (bits <= most_bits(percent / 100 - MARGIN))


def _sets(wanted: DataFrame, source: DataFrame) -> DataFrame:
    """(node, set): the full sets of the wanted (node, mark), packed, made anew from their texts.

    A bitmap of the texts' digests goes to all tasks first, so that other texts are neither read in Python nor shuffled;
    and rows of equal sets are dropped before the shuffle.
    """
    wanted = materialize(wanted, "wanted")
    rows = parted(source.select("text", F.xxhash64("text").alias("mark")), wanted, "mark")[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_batches(batches):
            sets = [found for found in map(shingles, texts) if len(found)]
            yield pa.RecordBatch.from_arrays([pa.array(map(_node, sets), pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], ["node", "set"])

    found = rows.select(F.col("mark").alias("key"), "text").mapInArrow(run, "node long, set binary")
    return materialize(found.dropDuplicates(["node"]).join(wanted.select("node"), "node", "left_semi"), "sets")


def _members(nodes: DataFrame) -> DataFrame:
    """(bucket, node, n, pivot) of buckets of several members; the pivot is the least, the same one in most buckets of a group.

    Buckets of a large share of all rows are fewer than their share says, so they are joined by a broadcast, and
    their rows do not meet in one task.
    """
    spark = nodes.sparkSession
    buckets = nodes.select("node", F.explode("buckets").alias("bucket"))
    pivots = materialize(buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1"), "pivots")
    least = nodes.count() * BANDS // (PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))) + 1
    large = F.broadcast(pivots.where(F.col("n") > least))
    small = buckets.join(large.select("bucket"), "bucket", "left_anti").join(pivots.where(F.col("n") <= least), "bucket")
    return materialize(buckets.join(large, "bucket").unionByName(small).select("bucket", "node", "n", "pivot"), "members")


def _measured(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes with ``far``, one less their similarity on full sets, and whether they are ``linked``."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far, good = [], []
            for one, two in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                far.append(1 - common / (len(a) + len(b) - common))
                good.append(linked(len(a), len(b), common, percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(far, pa.float64()), pa.array(good, pa.bool_())], ["a", "b", "far", "linked"])

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
    return materialize(joined.mapInArrow(run, "a long, b long, far double, linked boolean"), "measured")


def _lone(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, lone): how many shingles of each of these nodes no other one of them has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, packed in zip(batch.column("node").to_pylist(), batch.column("set")):
                found = np.frombuffer(packed.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), node)), pa.array(found)], ["node", "shingle"])

    each = sets.join(nodes, "node", "left_semi").dropDuplicates(["node"]).mapInArrow(run, "node long, shingle long")
    return each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1").groupBy("node").agg(F.count("*").alias("lone"))


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of buckets with more than one component, with the component as ``root``."""
    rows = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rows.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return materialize(rows.join(mixed.select("bucket"), "bucket"), "placed")


def _left_over(members: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, size, sketch, buckets, live) of members that may still get a link.

    ``live`` counts the shingles that another of them has. What two sets have in common is at most
    that of either, so a member with too many shingles of its own has no link at all.
    """
    placed = _rooted(members, roots)
    lone = _lone(sets, placed.select("node").distinct())
    live = nodes.join(lone, "node", "left").select("node", "size", "sketch", "buckets", (F.col("size") - F.coalesce("lone", F.lit(0))).alias("live"))
    return materialize(placed.drop("root").join(live.where(100 * F.col("live") >= percent * F.col("size")), "node"), "live")


def _to_common(placed: DataFrame) -> DataFrame:
    """(bucket, node, pivot): each member with the one of its bucket that has the smallest share of shingles of its own.

    In a group of copies that is the least changed one, to which all others are most alike.
    """
    pivots = placed.groupBy("bucket").agg(F.max(F.struct((F.col("live") / F.col("size")).alias("share"), "node")).alias("top"))
    return materialize(placed.join(pivots, "bucket").select("bucket", "node", F.col("top.node").alias("pivot")), "pivots")


def common_counts(one: list[np.ndarray], two: list[np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """How many elements each wanted pair of sets has in common; other pairs count as 0.

    Many pairs are counted by products of 0-1 matrices over the elements that both sides have, some at a time.
    """
    found = np.zeros(wanted.shape, np.int64)
    if wanted.sum() <= 64:
        for i, j in zip(*np.nonzero(wanted)):
            found[i, j] = len(np.intersect1d(one[i], two[j], assume_unique=True))
        return found
    left, right = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
    sides = []
    for rows, sets in ((left, one), (right, two)):
        line = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
        sides.append((line, np.concatenate([sets[r] for r in rows])))
    both = np.intersect1d(sides[0][1], sides[1][1])
    spots = []
    for line, elements in sides:
        at = np.searchsorted(both, elements)
        shared = (at < len(both)) & (both[np.minimum(at, len(both) - 1)] == elements) if len(both) else np.zeros(len(elements), bool)
        order = np.argsort(at[shared], kind="stable")
        spots.append((line[shared][order], at[shared][order]))
    total = np.zeros((len(left), len(right)))
    for first in range(0, len(both), COLUMNS):
        flat = []
        for rows, (line, at) in zip((left, right), spots):
            cut = slice(*np.searchsorted(at, [first, first + COLUMNS]))
            flat.append(np.zeros((len(rows), min(COLUMNS, len(both) - first)), np.float32))
            flat[-1][line[cut], at[cut] - first] = 1
        total += flat[0] @ flat[1].T
    found[np.ix_(left, right)] = np.where(wanted[np.ix_(left, right)], total.round().astype(np.int64), 0)
    return found


def _joining(pairs: Iterator[tuple[int, int]], roots_one: np.ndarray, roots_two: np.ndarray) -> list[tuple[int, int]]:
    """Those of the pairs that join two components, given the components so far."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while x in parent:
            up = parent[x]
            if up in parent:
                parent[x] = parent[up]
            x = up
        return x

    kept = []
    for i, j in pairs:
        a, b = top(int(roots_one[i])), top(int(roots_two[j]))
        if a != b:
            parent[a] = b
            kept.append((i, j))
    return kept


def _across(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of full sets between members of one bucket in different components.

    Sets are compared if what they share with any other, their sketches, and how ``far`` each is from the bucket's
    pivot allow a link: one less the similarity is a metric, so linked sets are about as far from any third.

    A component with many members in a bucket has blocks of its own, which do not meet each other; the
    others share blocks. So a bucket with one large component costs its members times the few left over. Of two
    blocks only links that join components come back, fewer than the blocks have members.
    """
    counts = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.sum("size").alias("held"))
    counts = counts.withColumn("own", F.when(F.col("n") >= BLOCK // 2, F.col("root")))
    totals = counts.groupBy("bucket", "own").agg(F.ceil(F.greatest(F.sum("n") / BLOCK, F.sum("held") / BLOCK_SHINGLES)).alias("slices"))
    numbered = placed.join(counts.select("bucket", "root", "own"), ["bucket", "root"])
    blocks = numbered.join(totals.withColumnRenamed("own", "own_").withColumnRenamed("bucket", "bucket_"), (F.col("bucket") == F.col("bucket_")) & F.col("own").eqNullSafe(F.col("own_")))
    blocks = blocks.withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices"))).join(sets, "node")
    packed = blocks.groupBy("bucket", "own", "slice").agg(F.collect_list(F.struct("node", "root", "size", "live", "far", "sketch", "buckets", "set")).alias("held"))
    packed = materialize(packed.withColumn("block", F.xxhash64("own", "slice")), "blocks")
    one, two = packed.alias("one"), packed.alias("two")
    apart = (F.col("one.bucket") == F.col("two.bucket")) & (F.col("one.block") <= F.col("two.block")) & ~(F.coalesce(F.col("one.own") == F.col("two.own"), F.lit(False)))
    met = one.join(two, apart).select("one.bucket", (F.col("one.block") == F.col("two.block")).alias("self"), F.col("one.held").alias("one"), F.col("two.held").alias("two"))
    limit = most_bits(percent / 100 - MARGIN)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, itself, left, right in zip(*(batch.column(c) for c in ("bucket", "self", "one", "two"))):
                links = _block_links(_Block(left), _Block(right), bucket.as_py(), itself.as_py(), percent, limit)
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in range(2)], ["a", "b"])

    return materialize(met.mapInArrow(compare, "a long, b long").distinct(), "late")


class _Block:
    """Members of a bucket: numbers, sketches, buckets and sets as rows."""

    def __init__(self, block: pa.ListScalar) -> None:
        held = block.values
        self.node, self.root, self.size, self.live, self.far = (held.field(i).to_numpy(zero_copy_only=False) for i in range(5))
        self.sketch, self.buckets = (held.field(i).flatten().to_numpy(zero_copy_only=False).reshape(len(held), -1) for i in (5, 6))
        self.sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in held.field(7)]


def _block_links(one: _Block, two: _Block, bucket: int, itself: bool, percent: int, limit: int) -> list[tuple[int, int]]:
    """The links (a, b) between two blocks of a bucket that join components."""
    wanted = one.root[:, None] != two.root[None, :]
    if itself:
        wanted = np.triu(wanted, 1)
    wanted &= np.abs(one.far[:, None] - two.far[None, :]) <= 1 - percent / 100 + 1e-9
    common = np.minimum(one.live[:, None], two.live[None, :])
    wanted &= 100 * common >= percent * (one.size[:, None] + two.size[None, :] - common)
    for i in np.flatnonzero(wanted.any(axis=1)):
        here = np.flatnonzero(wanted[i])
        good = np.bitwise_count((one.sketch[i] ^ two.sketch[here]).view(np.uint64)).sum(axis=1) <= limit
        # The first bucket that holds both is the one that compares them.
        good &= one.buckets[i][(one.buckets[i] == two.buckets[here]).argmax(axis=1)] == bucket
        wanted[i, here] = good
    common = common_counts(one.sets, two.sets, wanted)
    union = one.size[:, None] + two.size[None, :] - common
    good = (common > 0) & (100 * common >= percent * union)
    joining = _joining(zip(*np.nonzero(good)), one.root, two.root)
    return [(int(min(one.node[i], two.node[j])), int(max(one.node[i], two.node[j]))) for i, j in joining]


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (the smallest key reachable) and ``kept`` (whether it is that).

    Two documents are linked if ``100 * common >= percent * union`` of their distinct shingles. A null or
    empty text, or one without words, has none and is linked with nothing: its component is its own key. One
    row for each row; repeated rows are of one class and all kept where their key is the smallest. A null key links
    like any other and is never the smallest: it is not kept, and ``component_id`` is null if no member has a key. Other
    columns are not carried.

    A link is lost only if a pair meets in no bucket (5e-6 at the threshold, less above) or its sketches
    mislead (2e-7 there), and then only if no other way joins the two.
    """
    # A row may hold two blocks of sets, so the rows of a batch are bounded by their bytes.
    bound_batches(docs.sparkSession)
    source = keyed_text(docs, key, text)
    marked = source.select(F.struct("key", F.xxhash64("text").alias("mark")).alias("key"), "text")
    every = materialize(_sketched(marked).select("key.key", "key.mark", "size", "node", "buckets", "sketch"), "sketches")
    placed = every.where("node IS NOT NULL")
    # Of the texts with one set any one is its mark.
    nodes = placed.groupBy("node").agg(F.min("key").alias("key"), F.first(F.struct("mark", "size", "buckets", "sketch")).alias("x")).select("node", "key", "x.*")
    nodes = materialize(nodes, "nodes")
    members = _members(nodes)
    tried = materialize(members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "tried")
    details = nodes.select("node", "size", "sketch")
    a, b = details.alias("one"), details.alias("two")
    likely = tried.join(a, F.col("a") == F.col("one.node")).join(b, F.col("b") == F.col("two.node")).where(_alike("one", "two", percent)).select("a", "b")
    sets = _sets(nodes.select("node", "mark").join(members.select("node").distinct(), "node", "left_semi"), source)
    links = _measured(materialize(likely, "likely"), sets, percent).where("linked").select("a", "b")
    roots = components(links)
    left = _left_over(members.where("n > 2").select("bucket", "node"), roots, nodes, sets, percent)
    pivoted = _to_common(left)
    ends = (F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    measured = _measured(pivoted.where("node <> pivot").select(*ends).distinct(), sets, percent)
    links = materialize(links.unionByName(measured.where("linked").select("a", "b")), "linked")
    roots = components(links)
    distances = pivoted.select("bucket", "node", *ends).join(measured, ["a", "b"], "left").select("bucket", "node", F.coalesce("far", F.lit(0.0)).alias("far"))
    late = _across(_rooted(left.join(distances, ["bucket", "node"]), roots), sets, percent)
    if not late.isEmpty():
        roots = components(links.unionByName(late))
    joined = nodes.select("node", "key").join(roots, "node", "left").select("node", "key", F.coalesce("root", "node").alias("root"))
    least = joined.groupBy("root").agg(F.min("key").alias("component_id"))
    labels = joined.join(least, "root").select("node", "component_id")
    labelled = every.join(labels, "node", "left").select("key", F.col("size").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id"))
    return labelled.select(F.col("key").alias(key), "n_shingles", "component_id", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("kept"))
