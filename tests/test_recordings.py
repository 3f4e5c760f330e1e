"""Hand cases of reading, cleaning and derived columns."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reedbed.config import OTHER, ClassMapping, CleaningCriteria
from reedbed.operators import anchors, clean, derive, strategies
from reedbed.sources import quoted_csv, recordings

MAPPING = ClassMapping((OTHER, "a", "b", "c"))
RAW = recordings.RAW_SCHEMA.simpleString().removeprefix("struct<").removesuffix(">")


def raw_row(id, **changes):
    base = dict.fromkeys(recordings.REQUIRED_COLUMNS)
    base |= {"id": id, "call_audio": "u", "validated_frog_names": "['a']", "validated_frog_ids": "[1]", "validated_status": "published"}
    return tuple((base | changes)[c] for c in recordings.REQUIRED_COLUMNS)


def raw(spark, *given):
    return spark.createDataFrame(list(given), RAW.replace(":", " "))


def named(spark, lists, ids=None):
    """Rows with parsed lists."""
    data = [(i, n, ids[i] if ids else list(range(len(n or [])))) for i, n in enumerate(lists)]
    df = spark.createDataFrame(data, "id bigint, validated_frog_names array<string>, validated_frog_ids array<bigint>")
    return df.withColumn("species_names", F.col("validated_frog_names"))


def test_missing_columns_are_an_error_and_extra_ones_go(spark):
    df = raw(spark, raw_row(1)).withColumn("extra", F.lit(1))
    assert recordings.require_columns(df).columns == recordings.REQUIRED_COLUMNS
    with pytest.raises(ValueError, match="state"):
        recordings.require_columns(df.drop("state"))


def test_only_lists_are_parsed(spark):
    texts = ["['a', 'b']", "[]", "abc", None, '["d\'e"]', " ['a'] "]
    df = raw(spark, *[raw_row(i, validated_frog_names=t) for i, t in enumerate(texts)])
    got = [r[0] for r in recordings.parse_list_columns(df).orderBy("id").select("validated_frog_names").collect()]
    assert got == [["a", "b"], [], None, None, ["d'e"], ["a"]]


def test_csv_round_trip_keeps_blanks_quotes_and_line_breaks(spark, tmp_path):
    df = raw(
        spark,
        raw_row(1, call_audio="  ", validator_note_public='say "hi"\nthere', quality_call=False),
        raw_row(2, validated_frog_names='["d\'e"]', is_duplicate=True),
    )
    path = str(tmp_path / "csv")
    writer = df.coalesce(1).write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    back = recordings.read_recordings(spark, path)
    assert rows(back, *back.columns) == rows(df, *df.columns)


@pytest.mark.parametrize(
    ("fn", "column", "dropped"),
    [
        (clean.filter_not_duplicate, "is_duplicate", True),
        (clean.filter_appropriate, "inappropriate_content", True),
        (clean.filter_no_people, "has_people_activity", True),
        (clean.filter_quality, "quality_call", False),
    ],
)
def test_missing_flags_pass(spark, fn, column, dropped):
    df = raw(spark, raw_row(1, **{column: True}), raw_row(2, **{column: False}), raw_row(3))
    kept = [r[0] for r in rows(fn(df), "id")]
    assert kept == [i for i, v in ((1, True), (2, False), (3, None)) if v is not dropped]


def test_blank_audio_and_empty_lists_are_dropped(spark):
    df = recordings.parse_list_columns(
        raw(spark, raw_row(1, call_audio=" "), raw_row(2, call_audio=None), raw_row(3, validated_frog_names="[]"),
            raw_row(4, validated_frog_names="a"), raw_row(5, validated_status=None), raw_row(6))
    )
    assert rows(clean.clean_recordings(df), "id") == [(6,)]


def test_funnel_counts_each_order_and_skips_switched_off_steps(spark):
    df = recordings.parse_list_columns(
        raw(spark, raw_row(1), raw_row(2, validated_frog_names="x"), raw_row(3, validated_status="draft"), raw_row(4, is_duplicate=True))
    )

    def counts(**kw):
        return [(r["step"], r["count"]) for r in clean.filter_funnel(df, **kw).orderBy("step_number").collect()]

    assert counts()[:4] == [("raw", 4), ("published", 3), ("has_audio", 3), ("labelled", 2)]
    assert counts(order="dashboard")[:4] == [("raw", 4), ("labelled", 3), ("published", 2), ("has_audio", 2)]
    loose = CleaningCriteria(allow_duplicates=True)
    assert counts(criteria=loose)[-1][1] == 2 and "not_duplicate" not in dict(counts(criteria=loose))
    last = clean.filter_funnel(df).orderBy(F.col("step_number").desc()).first()
    assert last["count"] == clean.clean_recordings(df).count() == 1 and last["percentage"] == 25.0
    with pytest.raises(ValueError):
        clean.filter_funnel(df, order="other")


def test_times_keep_the_wall_clock(spark):
    texts = ["2020-03-04 05:06:07", "2020-03-04T23:00:00+10:00", "3/4/2020 5:06", "4 Mar 2020 05:06:07", "nonsense", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, capture_time string")
    got = [r[1] for r in derive.parse_capture_time(df).orderBy("id").collect()]
    assert got == [
        dt.datetime(2020, 3, 4, 5, 6, 7), dt.datetime(2020, 3, 4, 23), dt.datetime(2020, 3, 4, 5, 6),
        dt.datetime(2020, 3, 4, 5, 6, 7), None, None, None,
    ]
    parts = derive.temporal_features(derive.parse_capture_time(df)).orderBy("id").collect()
    assert [(r["year"], r["month"], r["hour"]) for r in parts][1] == (2020, 3, 23)
    assert parts[4]["year"] is None


def test_times_in_free_form(spark):
    at, day = dt.datetime(2025, 3, 17, 21, 12), dt.datetime(2025, 3, 17)
    cases = {
        "3/17/2025 9:12 PM": at, "2025-03-17 9:12 PM": at, "17/03/2025 21:12": at, "Mar 17, 2025": day, "17 March 2025": day,
        "2025/03/17 21:12": at, "20250317": day, "Mon Mar 17 21:12:00 2025": at, "March 17, 2025 9:12 p.m.": at, "17 mar 2025 9:12pm": at,
        "17-03-2025": day, "17-03-2025 21:12": at, "03/17/25": day, "17/03/25 9:12 pm": at, "17 Mar 2025 9.12pm": at,
        "12:30 2025-03-17": dt.datetime(2025, 3, 17, 12, 30), "9:12 pm 17 March 2025": at, "3-4-25": dt.datetime(2025, 3, 4),
        "3/4/2025": dt.datetime(2025, 3, 4), "31/31/2025": None, "not a time": None, "": None, None: None,
    }
    df = spark.createDataFrame(list(enumerate(cases)), "id int, capture_time string")
    assert [r[1] for r in derive.parse_capture_time(df).orderBy("id").collect()] == list(cases.values())
    assert derive.unparsed_times(df).first()["unparsed"] == 2


def test_counts_come_from_ids_and_targets_from_names(spark):
    lists = [["a", "a", "x"], ["x"], ["a"], ["a", "b"], ["a"]]
    df = named(spark, lists, [[1, 2], [9], [], [1, 2], [1]])
    df = derive.target_species_count(derive.species_count_features(df), MAPPING.species)
    df = derive.species_type(derive.target_species_ratio(derive.includes_target(df, MAPPING.species)))
    got = df.orderBy("id").select("species_count", "target_species_count", "target_species_ratio", "species_type", "includes_target_species")
    assert [tuple(r) for r in got.collect()] == [
        (2, 2, 1.0, "Target Only", True), (1, 0, 0.0, "Other", False), (0, 1, 0.0, "Mixed", True),
        (2, 2, 1.0, "Target Only", True), (1, 1, 1.0, "Target Only", True),
    ]


def test_labels(spark):
    lists = [["a"], ["x"], ["a", "b"], ["x", "y"], [OTHER]]
    df = named(spark, lists)
    plain = derive.single_label(df, MAPPING).orderBy("id")
    got = plain.select("species_name_single", "class_label_single", "class_name_single").collect()
    assert [tuple(r) for r in got] == [
        ("a", 1, "a"), ("x", 0, OTHER), (None, 0, OTHER), (None, 0, OTHER), (OTHER, 0, OTHER),
    ]
    no_other = ClassMapping(("a", "b"))
    labels = [r[0] for r in derive.single_label(df, no_other).orderBy("id").select("class_label_single").collect()]
    assert labels == [0, None, None, None, None]
    vectors = derive.multi_hot_vector(derive.class_labels(df, MAPPING), MAPPING.species).orderBy("id")
    assert [r[0] for r in vectors.select("class_labels").collect()] == [[1], [], [1, 2], [], [0]]
    assert [r[0] for r in vectors.select("class_label_vector").collect()][2] == [0, 1, 1, 0]


def test_mapping_labels_are_positions():
    assert ClassMapping.from_dict({0: OTHER, 1: "a"}).species == (OTHER, "a")
    with pytest.raises(ValueError):
        ClassMapping.from_dict({1: "a", 2: "b"})
    with pytest.raises(ValueError):
        ClassMapping(("a", "a"))
    assert len(ClassMapping().species) == 16


def test_anchors_and_frequency_ties(spark):
    """Equal frequencies go to the first of the sorted list."""
    df = named(spark, [["b", "x"], ["a", "b"], ["a", "x"], ["x"], ["y", "z"]])
    got = {n: [r[0] for r in fn(df, ("a", "b")).orderBy("id").select("anchor_species").collect()] for n, fn in anchors.ANCHORS.items()}
    assert got["first"] == ["b", "a", "a", "x", "y"]
    assert got["first-target"] == ["b", "a", "a", None, None]
    assert got["most-frequent"] == ["x", "a", "x", "x", "y"]
    assert got["most-frequent-target"] == ["b", "a", "a", None, None]


def test_python_anchor_decides_for_several_species_only(spark):
    last = anchors.python_anchor(lambda names, targets: names[-1])
    df = derive.single_label(named(spark, [["a"], ["a", "c"]]), MAPPING, last).orderBy("id")
    assert [tuple(r) for r in df.select("species_name_single", "class_label_single").collect()] == [("a", 1), ("c", 3)]


def test_rare_species_keep_a_row_with_any_of_them(spark):
    df = named(spark, [["a"], ["a", "b"], ["a"], ["c", "c"]])
    assert rows(strategies.rare_species_only(df, 2), "id") == [(1,)]
    assert rows(strategies.rare_species_only(df, 3), "id") == [(1,), (3,)]


def test_anchors_and_frequency_filters_with_repeated_and_null_ids(spark):
    data = [(1, ["A", "B"]), (1, ["C", "C"]), (None, ["A"]), (None, None), (2, []), (3, ["D", None])]
    df = spark.createDataFrame(data, "id bigint, species_names array<string>")
    got = {(r[0], tuple(r[1] or ())): r[2] for r in anchors.anchor_most_frequent(df).select("id", "species_names", "anchor_species").collect()}
    assert got == {(1, ("A", "B")): "A", (1, ("C", "C")): "C", (None, ("A",)): "A", (None, ()): None, (2, ()): None, (3, ("D", None)): "D"}
    kept = strategies.keep_by_frequency(df, lambda n: n >= 2).select("id", "species_names").collect()
    assert sorted((r[0] or 0, r[1]) for r in kept) == [(0, ["A"]), (1, ["A", "B"]), (1, ["C", "C"])]
    assert anchors.anchor_most_frequent(df.limit(0)).count() == 0 and anchors.anchor_most_frequent(df).columns == ["id", "species_names", "anchor_species"]


def test_top3_breaks_ties_by_label(spark):
    data = [(i, True, 2, True, label) for i, label in enumerate([5, 5, 1, 2, 3, 4, None])]
    df = spark.createDataFrame(
        data, "id int, is_multi_species boolean, species_count int, includes_target_species boolean, class_label_single int"
    )
    assert rows(strategies.multi_2_top3_targets(df), "class_label_single") == [(1,), (2,), (5,), (5,)]
    assert strategies.multi_3_top3_targets(df).count() == 0


def test_unknown_strategy_is_an_error(spark):
    df = named(spark, [["a"]])
    with pytest.raises(ValueError, match="nope"):
        strategies.apply_strategy(df, "nope")
    assert strategies.apply_strategy(df, None) is df
    strategies.register_strategy("none-at-all", lambda d: d.limit(0))
    try:
        assert strategies.apply_strategy(df, "none-at-all").count() == 0
    finally:
        del strategies.STRATEGIES["none-at-all"]


def test_cleaned_and_report_layouts(spark):
    df = raw(spark, raw_row(1, validated_frog_names="['b', 'a']", validated_frog_ids="[2, 1]", capture_time="2021-05-06 07:08:09"))
    got = derive.cleaned_recordings(df, MAPPING).first()
    assert got.asDict()["species_names"] == ["a", "b"] and got["month"] == 5 and got["class_label_single"] == 0
    assert list(got.asDict()) == clean.CLEANED_COLUMNS
    report = derive.dashboard_frame(df, ("a",)).first()
    assert (report["first_species_name"], report["sorted_species_names"], report["first_species_id"]) == ("b", ["a", "b"], 2)


def test_flags_as_numbers(spark, tmp_path):
    (tmp_path / "r.csv").write_text("id,is_duplicate,quality_call\n1,1,0\n2,0.0,True\n3,,false\n4,1.0,\n")
    from reedbed.sources.recordings import read_recordings

    got = read_recordings(spark, str(tmp_path / "r.csv"), multi_line=False)
    assert rows(got, "id", "is_duplicate", "quality_call") == [(1, True, False), (2, False, True), (3, None, False), (4, True, None)]


def test_python_lists(spark):
    df = spark.createDataFrame([("['A', None]", "[1.0, nan]"), ("['B',]", "[2,]"), ("['None']", "[3]")], "validated_frog_names string, validated_frog_ids string")
    assert rows(recordings.parse_list_columns(df), "validated_frog_names", "validated_frog_ids") == [(["A", None], [1, None]), (["B"], [2]), (["None"], [3])]


def test_words_inside_quotes_are_no_missing_entries(spark):
    texts = ["['a, None, b', None]", '["x [nan] y", nan ]', "['it, nan', \"None, d'e\", None,]", "['open, None]", "[None]", "[Nonesuch]"]
    df = raw(spark, *[raw_row(i, validated_frog_names=t) for i, t in enumerate(texts)])
    got = [r[0] for r in recordings.parse_list_columns(df).orderBy("id").select("validated_frog_names").collect()]
    assert got == [["a, None, b", None], ["x [nan] y", None], ["it, nan", "None, d'e", None], None, [None], None]
    assert recordings.unparsed_lists(df).first().asDict() == {"validated_frog_names": 2, "validated_frog_ids": 0}


def quoted_file(seed):
    """Text of a CSV file whose notes hold quotes, commas, line breaks and blank lines."""
    rng = random.Random(seed)
    note = lambda: "".join(rng.choice(["a", "b ", '""', ",", "\n", "\r\n", "\n\n", "\u00e9"]) for _ in range(rng.randint(0, 5)))
    lines = [f'{i},"{note()}",{rng.choice(["x", "", "y z"])}' for i in range(5)]
    end = rng.choice(["\n", "\r\n"])
    return end.join(["id,note,state", *lines]) + rng.choice(["", end])


@pytest.mark.parametrize("block", [5, 17, 10_000])
def test_quoted_csv_cut_anywhere_equals_one_task(spark, tmp_path, block):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_bytes(quoted_file(f"{name}{block}").encode())
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("state", T.StringType())])
    whole = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
    changed = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        got = rows(quoted_csv.read_quoted_csv(spark, str(tmp_path), schema), "id", "note", "state")
        tasks = quoted_csv._lines(spark, str(tmp_path)).rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == rows(whole, "id", "note", "state") and len(got) == 10
    assert tasks > 2 or block == 10_000


def test_quoted_csv_with_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text("id,other\n2,z\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])
    with pytest.raises(Exception, match="another header"):
        quoted_csv.read_quoted_csv(spark, str(tmp_path), schema).collect()
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "e.csv").write_text("id,note\n")
    assert quoted_csv.read_quoted_csv(spark, str(tmp_path / "c"), schema).count() == 0
