import pytest
from helpers import day, exchanges, plan, rows
from pyspark.sql import functions as F

from casetrends.operators import (
    align_wide,
    asof_enrich,
    collapse_days,
    enrich,
    full_align,
    null_columns,
    null_tolerant_eq,
    series_metrics,
    stack_align,
    union_drifted,
    union_sources,
    unpivot_wide,
)


def long(spark, metric, data):
    return spark.createDataFrame(data, f"k string, dt date, place string, total_{metric} bigint")


def sides(spark):
    a = long(spark, "a", [("x", day(1), "A", 5), ("x", day(2), "A", 6)])
    b = long(spark, "b", [("x", day(1), "B", 1), ("y", day(1), "B", 2)])
    return a, b


@pytest.mark.parametrize("align", [full_align, stack_align])
def test_two_sides(spark, align):
    got = align(list(sides(spark)), on=["k", "dt"], describe=["place"])
    assert rows(got, "k", "dt") == [
        ("x", day(1), "A", 5, 1),
        ("x", day(2), "A", 6, 0),
        ("y", day(1), "B", 0, 2),
    ]


@pytest.mark.parametrize("align", [full_align, stack_align])
def test_no_fill(spark, align):
    got = align(list(sides(spark)), on=["k", "dt"], describe=["place"], fill=None)
    assert rows(got, "k", "dt")[1][-2:] == (6, None)


def test_key_that_only_later_frames_have(spark):
    a, b = sides(spark)
    c = long(spark, "c", [("y", day(1), "C", 9)])
    faithful = full_align([a, b, c], on=["k", "dt"], describe=["place"], coalesce_keys=False)
    assert rows(faithful.filter("k = 'y'"), "total_b") == [
        ("y", day(1), "C", 0, 0, 9),
        ("y", day(1), "B", 0, 2, 0),
    ]
    merged = full_align([a, b, c], on=["k", "dt"], describe=["place"])
    assert rows(merged.filter("k = 'y'")) == [("y", day(1), "B", 0, 2, 9)]
    assert rows(collapse_days(faithful, ["k"]).filter("k = 'y'")) == [("y", day(1), "C", 0, 2, 9)]


def test_stacking_refuses_repeated_keys(spark):
    a, b = sides(spark)
    got = stack_align([a.union(a), b], on=["k", "dt"], describe=["place"])
    with pytest.raises(Exception, match="not unique"):
        got.collect()


def test_join_multiplies_repeated_keys(spark):
    a, b = sides(spark)
    assert full_align([a, b.union(b)], on=["k", "dt"], describe=["place"]).count() == 5


def test_stacked_series_needs_one_exchange(spark):
    stacked = stack_align(list(sides(spark)), on=["dt", "k"], describe=["place"], cluster_by=["k"])
    text = plan(series_metrics(stacked, ["k"], ["a", "b"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1


def test_null_and_blank_keys_match(spark):
    left = spark.createDataFrame([(None, 1), ("", 2), ("s", 3)], "p string, l int")
    right = spark.createDataFrame([("", 10), ("t", 20)], "q string, r int")
    got = left.join(right, null_tolerant_eq(F.col("p"), F.col("q"))).select("l", "r")
    assert rows(got, "l") == [(1, 10), (2, 10)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, null_tolerant_eq(F.col("p"), F.col("q")))
        assert "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_enrich_repeats_rows_for_repeated_attributes(spark):
    df = spark.createDataFrame([("x", 1), ("z", 2)], "k string, v int")
    people = spark.createDataFrame([("x", 7, 0), ("x", 8, 0)], "k string, population bigint, other int")
    got = enrich(df, people, ["k"], ["population"])
    assert rows(got, "k", "population") == [("x", 1, 7), ("x", 1, 8), ("z", 2, None)]


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert rows(union_sources(a, b), "n") == [(1, "x"), (2, "y")]
    padded = union_sources(null_columns(a, {"rate": "double"}), b.withColumn("rate", F.lit(0.5)))
    assert rows(padded, "n") == [(1, "x", None), (2, "y", 0.5)]
    assert rows(union_drifted(a, b.drop("s")), "n") == [(1, "x"), (2, None)]


# --- wide alignment is the long alignment, with less to move --------------------------------------


def wide(spark, data, days):
    columns = ", ".join(f"dt_202001{d} bigint" for d in days)
    return spark.createDataFrame(data, f"k string, place string, {columns}")


def through_long(frames, **options):
    longs = [unpivot_wide(df, ["k", "place"], m) for m, df in frames.items()]
    return full_align(longs, on=["dt", "k"], describe=["place"], **options)


CASES = {
    "one-sided keys": ([("x", "A", 1, 2), ("z", "A", None, 4)], (22, 23), [("x", "B", 5, 6), ("y", "B", 7, None)], (22, 23)),
    "other dates": ([("x", "A", 1, 2), ("z", "A", 3, 4)], (22, 23), [("x", "B", 5, 6), ("y", "B", 7, 8)], (23, 24)),
    "repeated keys": ([("x", "A", 1, 2), ("x", "C", 3, 4)], (22, 23), [("x", "B", 5, 6), ("x", "D", 7, 8)], (22, 23)),
    "other dates, repeated keys": ([("x", "A", 1, 2), ("x", "C", 3, 4)], (22, 23), [("x", "B", 5, 6)], (23, 24)),
    "null keys": ([(None, "A", 1, 2)], (22, 23), [(None, "B", 5, 6), ("", "E", 9, 9)], (22, 23)),
    "no rows": ([], (22, 23), [("x", "B", 5, 6)], (22, 24)),
}


@pytest.mark.parametrize("tolerant", [(), ("k",)])
@pytest.mark.parametrize("case", CASES)
def test_wide_alignment_equals_long_alignment(spark, case, tolerant):
    left, left_days, right, right_days = CASES[case]
    frames = {"a": wide(spark, left, left_days), "b": wide(spark, right, right_days)}
    got = align_wide(frames, on=["k"], describe=["place"], null_tolerant=tolerant)
    want = through_long(frames, null_tolerant=tolerant)
    columns = ["dt", "k", "place", "total_a", "total_b"]
    assert rows(got.select(columns), *columns) == rows(want.select(columns), *columns)


@pytest.mark.parametrize("merge", [True, False])
def test_three_wide_frames(spark, merge):
    frames = {
        "a": wide(spark, [("x", "A", 1, 2)], (22, 23)),
        "b": wide(spark, [("x", "B", 3, 4), ("y", "B", 5, 6)], (22, 23)),
        "c": wide(spark, [("y", "C", 7, 8)], (22, 23)),
    }
    got = align_wide(frames, on=["k"], describe=["place"], coalesce_keys=merge)
    want = through_long(frames, coalesce_keys=merge)
    columns = ["dt", "k", "place", "total_a", "total_b", "total_c"]
    assert rows(got.select(columns), *columns) == rows(want.select(columns), *columns)
    assert got.filter("k = 'y'").count() == (2 if merge else 4)


def test_windows_over_wide_alignment_add_no_exchange(spark):
    frames = {m: wide(spark, [("x", "A", 1, 2)], (22, 23)) for m in ("a", "b")}
    aligned = align_wide(frames, on=["k"], describe=["place"])
    assert exchanges(series_metrics(aligned, ["k"], ["a", "b"])) == exchanges(aligned)


def test_stack_align_checks_whichever_columns_are_read(spark):
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, x bigint")
    once = spark.createDataFrame([("a", 3)], "k string, y bigint")
    stacked = stack_align([twice, once], on=["k"])
    for read in (stacked.select("k").collect, stacked.count):
        with pytest.raises(Exception, match="not unique"):
            read()


def _pairs(spark, seed, hot):
    """Two frames whose keys repeat, miss on either side, are NULL, or are hot."""
    import random

    random.seed(seed)
    sides = []
    for side, heavy in (("x", hot[0]), ("y", hot[1])):
        keys = [random.choice(["a", "b", "c", None, side]) for _ in range(30)] + heavy
        sides.append(spark.createDataFrame(
            [(k, i % 7) for i, k in enumerate(keys)], f"k string, {side} bigint"
        ).repartition(6))
    return sides


@pytest.mark.parametrize("hot", [
    (["h"] * 200, ["h"] * 3), (["h"] * 3, ["h"] * 200), (["h"] * 200, []), ([], ["h"] * 200),
    ([None] * 200, ["h"] * 100), (["h"] * 40, ["h"] * 40), ([], []),
])
def test_salted_join_equals_the_plain_one(spark, hot):
    frames = _pairs(spark, 3, hot)
    for options in ({}, {"null_tolerant": ["k"]}, {"fill": None}):
        plain = full_align(frames, on=["k"], **options)
        salted = full_align(frames, on=["k"], salts=8, **options)
        key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
        assert sorted(map(tuple, salted.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)


def test_salted_join_of_three_frames(spark):
    frames = _pairs(spark, 5, (["h"] * 60, ["h"] * 2))
    frames.append(spark.createDataFrame([("h", 1), ("z", 2), (None, 3), ("h", 4)], "k string, z bigint"))
    for coalesce_keys in (True, False):
        got = [
            sorted(map(repr, full_align(frames, on=["k"], coalesce_keys=coalesce_keys, salts=s).collect()))
            for s in (None, 4)
        ]
        assert got[0] == got[1]


def test_salted_join_spreads_a_hot_key(spark):
    from pyspark.sql import functions as F

    left = spark.range(40_000).select(F.lit("h").alias("k"), F.col("id").alias("x")).repartition(8)
    right = spark.createDataFrame([("h", 1), ("i", 2)], "k string, y bigint")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        assert largest(full_align([left, right], on=["k"])) == 40_000
        salted = full_align([left, right], on=["k"], salts=32)
        assert salted.count() == 40_001 and largest(salted) < 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_spreads_the_pairs_of_few_rows(spark):
    """So few rows that adaptive execution would read them all in one task; pairs are dealt in blocks of both sides."""
    from pyspark.sql import functions as F

    left = spark.range(3_000).select(F.lit("h").alias("k"), F.col("id").alias("x")).repartition(4)
    left = left.unionByName(spark.createDataFrame([("l", -1), (None, -2)], "k string, x bigint"))
    right = spark.range(1_200).select(F.lit("h").alias("k"), F.col("id").alias("y"))
    right = right.unionByName(spark.createDataFrame([("r", -1), (None, -2)], "k string, y bigint"))
    salted = full_align([left, right], on=["k"], salts=2, fill=None)
    sizes = [r["count"] for r in salted.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3_600_004 and max(sizes) < 1_800_000
    assert salted.filter("k = 'h'").agg(F.count_distinct("x", "y")).first()[0] == 3_600_000


def _joined(node):
    """Rows that the joins of a plan that was run gave."""
    if node.nodeName().startswith("AdaptiveSparkPlan"):
        return _joined(node.executedPlan())
    if node.nodeName().endswith("QueryStage"):
        return _joined(node.plan())
    children = node.children()
    own = node.metrics().apply("numOutputRows").value() if "Join" in node.nodeName() else 0
    return own + sum(_joined(children.apply(i)) for i in range(children.length()))


def test_salted_join_does_not_join_pair_by_pair(spark):
    """The join gives a left row once for a block of right rows; the pairs come from unfolding the blocks."""
    left = spark.range(4_000).select(F.lit("h").alias("k"), F.col("id").alias("x")).repartition(4)
    right = spark.range(1_000).select(F.lit("h").alias("k"), F.col("id").alias("y"))
    salted = full_align([left, right], on=["k"], salts=2, fill=None)
    run = salted.selectExpr("k", "x", "y", "hash(k, x, y) AS row")._jdf.queryExecution()
    assert run.toRdd().count() == 4_000_000
    assert 0 < _joined(run.executedPlan()) < 100_000


def test_salted_join_of_rows_that_are_all_the_same(spark):
    """They are in one block, whose array is cut."""
    left = spark.range(300).select(F.lit("h").alias("k"), (F.col("id") % 2).alias("x")).coalesce(1)
    right = spark.range(2_500).select(F.lit("h").alias("k"), F.lit(None).cast("bigint").alias("y")).coalesce(1)
    right = right.unionByName(spark.createDataFrame([("h", 7), (None, 8), ("r", None)], "k string, y bigint"))
    salted = full_align([left, right], on=["k"], salts=4, fill=None)
    counts = {tuple(r)[:3]: r["count"] for r in salted.groupBy("k", "x", "y").count().collect()}
    assert counts == {
        ("h", 0, None): 375_000, ("h", 1, None): 375_000, ("h", 0, 7): 150, ("h", 1, 7): 150,
        (None, None, 8): 1, ("r", None, None): 1,
    }


def test_attributes_as_of_a_day(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("a", 9), (None, 5), ("b", 2)], "k string, dt int")
    known = spark.createDataFrame(
        [("a", 2, 20, "x"), ("a", 3, 30, None), ("a", 8, None, "z"), (None, 1, 7, "n"), ("b", 3, 1, "late")],
        "k string, dt int, people int, note string",
    )
    got = asof_enrich(df, known, ["k"], ["people", "note"])
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted([
        ("a", 1, None, None), ("a", 3, 30, None), ("a", 3, 30, None), ("a", 9, None, "z"),
        (None, 5, 7, "n"), ("b", 2, None, None),
    ], key=key)
