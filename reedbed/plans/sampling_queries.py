"""Queries over sampling and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from reedbed.config import SamplingStrategy
from reedbed.operators import sampling
from reedbed.plans import fixtures as fx
from reedbed.plans import sql as q
from reedbed.plans.registry import query

# Fixed values that suit the class sizes of the fixture.
CAP = 100
UP_CAP = 200
OTHER_SIZE = 300
ID_LABEL = ["id", "class_label_single"]

_TARGETS = "pool AS (SELECT * FROM cleaned WHERE species_type = 'Target Only' AND class_label_single IS NOT NULL)"
_OTHERS = "others AS (SELECT * FROM cleaned WHERE species_type = 'Other')"
_BY_KEY = q.key("id")


def _cleaned(spark, sf_dir):
    return fx.cleaned(spark, sf_dir, "first-target")


_CLEANED = q.cleaned("first-target")


@query(
    "sample_target_downsample",
    f"""WITH {_CLEANED}, {_TARGETS} SELECT id, class_label_single FROM pool
    QUALIFY row_number() OVER (PARTITION BY class_label_single ORDER BY {_BY_KEY}) <= {CAP}""",
)
def _(spark, sf_dir):
    return sampling.sample_target_downsample(_cleaned(spark, sf_dir), CAP).select(*ID_LABEL)


@query(
    "sample_target_upsample",
    f"""WITH {_CLEANED}, {_TARGETS},
    ranked AS (SELECT id, class_label_single AS label, row_number() OVER (PARTITION BY class_label_single ORDER BY {_BY_KEY}) AS r FROM pool),
    sizes AS (SELECT label, count(*) AS n FROM ranked GROUP BY 1),
    draws AS (SELECT label, n, unnest(range(greatest(n, {UP_CAP}))) AS draw FROM sizes),
    picks AS (SELECT label, draw, CAST('0x' || substr(md5('42:' || label || ':' || draw), 1, 15) AS BIGINT) % n + 1 AS r FROM draws)
    SELECT k.id, k.label AS class_label_single, p.draw FROM picks p JOIN ranked k ON k.label = p.label AND k.r = p.r""",
)
def _(spark, sf_dir):
    return sampling.sample_target_upsample(_cleaned(spark, sf_dir), UP_CAP).select(*ID_LABEL, "draw")


@query("sample_target_none", f"WITH {_CLEANED}, {_TARGETS} SELECT id, class_label_single FROM pool")
def _(spark, sf_dir):
    return sampling.sample_target_none(_cleaned(spark, sf_dir)).select(*ID_LABEL)


_FREQUENT = """frequent AS (
  SELECT list(s) AS names FROM (
    SELECT s FROM (SELECT unnest(species_names) AS s FROM others) GROUP BY s
    HAVING count(*) >= {n}))"""


@query(
    "exclude_rare_other",
    f"""WITH {_CLEANED}, {_OTHERS}, {_FREQUENT.format(n=160)}
    SELECT id, class_label_single FROM others WHERE list_has_any(species_names, (SELECT names FROM frequent))""",
)
def _(spark, sf_dir):
    return sampling.exclude_rare_other(_cleaned(spark, sf_dir), 160).select(*ID_LABEL)


@query(
    "sample_other_random",
    f"WITH {_CLEANED}, {_OTHERS} SELECT id, class_label_single FROM others ORDER BY {_BY_KEY} LIMIT {OTHER_SIZE}",
)
def _(spark, sf_dir):
    return sampling.sample_other_random(_cleaned(spark, sf_dir), OTHER_SIZE).select(*ID_LABEL)


@query(
    "sample_other_stratified",
    f"""WITH {_CLEANED}, {_OTHERS},
    share AS (SELECT greatest(1, {OTHER_SIZE} // count(DISTINCT species_names)) AS n FROM others),
    even AS (SELECT id FROM others
      QUALIFY row_number() OVER (PARTITION BY species_names ORDER BY {_BY_KEY}) <= (SELECT n FROM share)),
    rest AS (SELECT id, row_number() OVER (ORDER BY {_BY_KEY}) AS r FROM others WHERE id NOT IN (SELECT id FROM even)),
    taken AS (SELECT id FROM even UNION ALL SELECT id FROM rest WHERE r <= {OTHER_SIZE} - (SELECT count(*) FROM even))
    SELECT id, class_label_single FROM others WHERE id IN (SELECT id FROM taken)""",
)
def _(spark, sf_dir):
    return sampling.sample_other_stratified(_cleaned(spark, sf_dir), OTHER_SIZE).select(*ID_LABEL)


@query(
    "sample_modelling_dataset",
    f"""WITH {_CLEANED}, single AS (SELECT * FROM cleaned WHERE NOT is_multi_species),
    t AS (SELECT id, class_label_single FROM single WHERE species_type = 'Target Only' AND class_label_single IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY class_label_single ORDER BY {_BY_KEY}) <= {CAP}),
    o AS (SELECT id, class_label_single FROM single WHERE species_type = 'Other' ORDER BY {_BY_KEY} LIMIT {round(CAP * 1.5)})
    SELECT * FROM t UNION ALL SELECT * FROM o""",
)
def _(spark, sf_dir):
    strategy = SamplingStrategy(max_samples_per_class=CAP, other_boost=1.5)
    return sampling.sample_modelling_dataset(_cleaned(spark, sf_dir), strategy).select(*ID_LABEL)


@query(
    "sample_hold_out",
    f"""WITH {_CLEANED}, {q.SPLITS}
    SELECT id, class_label_single FROM cleaned WHERE is_multi_species AND id NOT IN (SELECT id FROM split_ids)
    QUALIFY row_number() OVER (PARTITION BY class_label_single ORDER BY {_BY_KEY}) <= 10""",
)
def _(spark, sf_dir):
    rows = sampling.sample_hold_out(_cleaned(spark, sf_dir), fx.split_ids(spark, sf_dir), "multi-species-only", 10)
    return rows.select(*ID_LABEL)


def _stage(source: str, part: float, name: str) -> str:
    """CTEs that mark ``floor(n * part)`` ids of ``source`` as ``chosen`` in ``name``."""
    return f"""
{name}_c AS (SELECT label, count(*) AS n FROM {source} GROUP BY 1),
{name}_s AS (SELECT label, n, CAST(sum(n) OVER () AS BIGINT) AS total, count(label) OVER () AS classes,
    CAST(floor((SELECT count(*) FROM ids) * CAST({part} AS DOUBLE)) AS BIGINT) AS wanted FROM {name}_c),
{name}_b AS (SELECT *, (wanted * n) // total AS base, (wanted * n) % total AS rest,
    total >= classes AND wanted >= classes AS by_class FROM {name}_s),
{name}_q AS (SELECT label, by_class, wanted,
    base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= wanted - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM {name}_b),
{name} AS (SELECT i.id, i.label, row_number() OVER (PARTITION BY CASE WHEN by_class THEN i.label END ORDER BY {_BY_KEY})
    <= CASE WHEN by_class THEN quota ELSE wanted END AS chosen FROM {source} i JOIN {name}_q s ON s.label = i.label)"""


def _split_sql(test: float, val: float) -> str:
    return f"""{_stage('ids', test, 't')},
rest_ids AS (SELECT id, label FROM t WHERE NOT chosen),{_stage('rest_ids', val, 'v')},
split AS (SELECT id, 'test' AS split FROM t WHERE chosen
  UNION ALL SELECT id, CASE WHEN chosen THEN 'val' ELSE 'train' END FROM v)"""


_CHUNK_IDS = "ids AS (SELECT id, arg_min(class_label, chunk_index) AS label FROM features GROUP BY 1)"
_RECORDING_IDS = "ids AS (SELECT id, class_label_single AS label FROM cleaned)"


@query(
    "split_by_id",
    f"""WITH {q.FEATURES}, {_CHUNK_IDS}, {_split_sql(0.15, 0.15)}
    SELECT f.id, f.chunk_index, f.class_label, s.split FROM features f JOIN split s ON s.id = f.id""",
)
def _(spark, sf_dir):
    rows = fx.features(spark, sf_dir).select("id", "chunk_index", "class_label")
    return sampling.split_by_id(rows, "id", "class_label", "chunk_index", 0.15, 0.15)


@query(
    "split_sizes",
    f"""WITH {_CLEANED}, {_RECORDING_IDS}, {_split_sql(0.15, 0.15)}
    SELECT split, count(*) AS num_rows, count(DISTINCT id) AS num_ids FROM split GROUP BY 1""",
)
def _(spark, sf_dir):
    rows = _cleaned(spark, sf_dir).select("id", "class_label_single")
    return sampling.split_sizes(sampling.split_by_id(rows, "id", "class_label_single", "id", 0.15, 0.15), "id")


@query("shuffle_rows", f"WITH {_CLEANED} SELECT id, class_label_single FROM cleaned")
def _(spark, sf_dir):
    return sampling.shuffle_rows(_cleaned(spark, sf_dir)).select(*ID_LABEL)
