"""Putting metrics side by side: outer joins, enrichment and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casetrends.functions.dates import column_day, date_columns
from casetrends.operators.project import quoted
from casetrends.operators.reshape import day_literals, unpivot_wide


def null_tolerant_eq(left: Column, right: Column) -> Column:
    """NULL and '' are the same key. A plain equality of expressions, so joins can hash it."""
    return F.coalesce(left, F.lit("")) == F.coalesce(right, F.lit(""))


def _match(name: str, left: Column, right: Column, tolerant: Sequence[str]) -> Column:
    return null_tolerant_eq(left, right) if name in tolerant else left == right


def _sided(name: str, side: int) -> str:
    return f"{name}__{side}"


def _outer_chain(
    sides: list[DataFrame],
    on: Sequence[str],
    tolerant: Sequence[str],
    coalesce_keys: bool,
    salts: int | None = None,
) -> DataFrame:
    """FULL OUTER JOIN of frames whose columns carry a side suffix."""
    joined = sides[0]
    for i, side in enumerate(sides[1:], start=1):
        upto = range(i) if coalesce_keys else range(1)
        left = [F.coalesce(*[F.col(_sided(k, j)) for j in upto]) for k in on]
        right = [F.col(_sided(k, i)) for k in on]
        if salts is None:
            conditions = [_match(k, x, y, tolerant) for k, x, y in zip(on, left, right)]
            joined = joined.join(side, reduce(Column.__and__, conditions), "full")
        else:
            blank = [F.lit("") if k in tolerant else None for k in on]
            joined = salted_full_join(
                joined,
                side,
                [x if b is None else F.coalesce(x, b) for x, b in zip(left, blank)],
                [x if b is None else F.coalesce(x, b) for x, b in zip(right, blank)],
                salts,
            )
    return joined


# Rows of a hot key that are paired with as many of the other side at a time.
BLOCK = 512


def salted_full_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[Column],
    right_keys: Sequence[Column],
    salts: int,
) -> DataFrame:
    """FULL OUTER JOIN on equal keys where a key may hold a large share of a side's rows.

    Spark cannot split a hot key of a full outer join, and holds all its pairs at once. Here a key
    is hot with more than one ``salts``-th of all rows, or with more pairs than there are rows in
    all; there are at most ``2 * salts`` of the first and, for n rows, sqrt(n) / 2 of the second, so
    their list is broadcast.

    A hot key that both sides have matches all its rows, so its pairs need no outer join
    (``_met_blocks``): each side's rows are dealt into blocks of about ``BLOCK``, by a hash of the
    row and its input partition, and each block meets all blocks of the other side; the side with
    more rows has ``salts`` blocks at least. All other rows are joined as they are, where a hot key
    of one side, or one with a NULL in it, is dealt into its blocks.

    A few rows make many pairs, so the number of tasks is the session's number of shuffle
    partitions, whatever the size of what is shuffled. The two frames are read three times, once to
    count their keys and once for each of the joins. Column names must differ.
    """
    names = [f"key{i}" for i in range(len(left_keys))]
    sides = []
    for df, keys, suffix in ((left, left_keys, "l"), (right, right_keys, "r")):
        columns = {f"{n}__{suffix}": k for n, k in zip(names, keys)}
        columns[f"at__{suffix}"] = F.xxhash64(
            *[F.col(quoted(c)) for c in df.columns], F.spark_partition_id()
        )
        sides.append(df.withColumns(columns))
    counted = reduce(
        DataFrame.unionByName,
        [
            df.select(
                *[F.col(f"{n}__{own}").alias(n) for n in names],
                *[F.lit(int(own == side)).alias(f"n__{side}") for side in "lr"],
            )
            for df, own in zip(sides, "lr")
        ],
    ).groupBy(*names).agg(F.sum("n__l").alias("n__l"), F.sum("n__r").alias("n__r"))
    total = counted.agg(F.sum(F.col("n__l") + F.col("n__r"))).scalar()
    whole = reduce(Column.__and__, [F.col(n).isNotNull() for n in names])
    pairs = F.col("n__l").cast("double") * F.col("n__r")
    both = whole & (F.col("n__l") > 0) & (F.col("n__r") > 0)
    most = F.greatest("n__l", "n__r")

    def blocks(count: Column) -> Column:
        size = F.ceil(count / BLOCK)
        return F.when(both & (count < most), size).otherwise(F.greatest(size, F.lit(salts)))

    hot = counted.filter((most * salts > total) | (whole & (pairs > total))).select(
        *names, both.alias("both"), *[blocks(F.col(f"n__{side}")).alias(f"blocks__{side}") for side in "lr"]
    )
    paired, others = [], []
    for df, own, other in zip(sides, "lr", "rl"):
        marks = hot.select(
            *[F.col(n).alias(f"{n}__h{own}") for n in names],
            F.col("both").alias(f"both__{own}"),
            F.col(f"blocks__{own}").alias(f"own__{own}"),
            F.col(f"blocks__{other}").alias(f"others__{own}"),
        )
        same = [F.col(f"{n}__{own}").eqNullSafe(F.col(f"{n}__h{own}")) for n in names]
        block = F.coalesce(F.pmod(f"at__{own}", f"own__{own}"), F.lit(0).cast("long"))
        marked = df.join(F.broadcast(marks), reduce(Column.__and__, same), "left").withColumn(
            f"block_{own}__{own}", block
        )
        paired.append(marked.filter(f"both__{own}"))
        others.append(
            marked.filter(~F.coalesce(f"both__{own}", F.lit(False)))
            .withColumnRenamed(f"block_{own}__{own}", f"block__{own}")
        )
    kept = [F.col(quoted(c)) for c in left.columns]
    shown = [F.col(quoted(c)) for c in right.columns]
    rest = _join_dealt(*others, ["block", *names], "full").select(*kept, *shown)
    met = _met_blocks(*paired, names, F.struct(*shown))
    return rest.union(met.select(*kept, F.inline("rows__r").alias(*right.columns)))


def _join_dealt(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join of frames whose keys carry a side suffix, over as many tasks as there are shuffle partitions."""
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = [df.repartition(tasks, *[f"{n}__{own}" for n in on]) for df, own in zip((left, right), "lr")]
    same = [F.col(f"{n}__l") == F.col(f"{n}__r") for n in on]
    return spread[0].join(spread[1], reduce(Column.__and__, same), how)


def _met_blocks(left: DataFrame, right: DataFrame, names: Sequence[str], row: Column) -> DataFrame:
    """Each left row with each block of its key's right rows, as the array ``rows__r``.

    The join makes one row for a left row and a block; unfolding the array makes the pairs, in the
    same task. Rows that are all the same are in one block, so an array is cut after ``2 * BLOCK``
    rows, and a block may have several.
    """
    none = F.lit(0).cast("long")
    others = {own: F.explode(F.sequence(none, F.col(f"others__{own}") - 1)) for own in "lr"}
    block = [*[f"{n}__r" for n in names], "block_r__r", "others__r"]
    place = F.row_number().over(Window.partitionBy(*block).orderBy("at__r")) - 1
    arrays = (
        right.withColumn("part__r", F.floor(place / (2 * BLOCK)))
        .groupBy(*block, "part__r")
        .agg(F.collect_list(row).alias("rows__r"))
    )
    return _join_dealt(
        left.withColumn("block_r__l", others["l"]),
        arrays.withColumn("block_l__r", others["r"]),
        ["block_l", "block_r", *names],
        "inner",
    )


def _merged(name: str, count: int) -> Column:
    return F.coalesce(*[F.col(_sided(name, i)) for i in range(count)]).alias(name)


def full_align(
    frames: Sequence[DataFrame],
    on: Sequence[str],
    *,
    describe: Sequence[str] = (),
    fill: int | None = 0,
    null_tolerant: Sequence[str] = (),
    coalesce_keys: bool = True,
    salts: int | None = None,
) -> DataFrame:
    """FULL OUTER JOIN of long metric frames on ``on``.

    ``describe`` columns come from the first frame that has the row. Every other column is a
    metric; a metric missing from a row becomes ``fill`` (None leaves it NULL).

    ``coalesce_keys=False`` compares the third and later frames with the first one only. A
    key that the first frame lacks then gives one row per later frame that has it.

    ``salts`` spreads keys that hold more than that part of the rows over tasks
    (``salted_full_join``); the rows are the same.
    """
    shared = [*on, *describe]
    metrics = [[c for c in df.columns if c not in shared] for df in frames]
    sides = [
        df.select(*[F.col(quoted(c)).alias(_sided(c, i)) for c in [*shared, *metrics[i]]])
        for i, df in enumerate(frames)
    ]
    joined = _outer_chain(sides, on, null_tolerant, coalesce_keys, salts)
    values = []
    for i, names in enumerate(metrics):
        for m in names:
            value = F.col(_sided(m, i))
            values.append((value if fill is None else F.coalesce(value, F.lit(fill))).alias(m))
    return joined.select(*[_merged(c, len(frames)) for c in shared], *values)


def stack_align(
    frames: Sequence[DataFrame],
    on: Sequence[str],
    *,
    describe: Sequence[str] = (),
    fill: int | None = 0,
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """``full_align`` as one union and one grouping, for frames with unique keys.

    Rows are combined before the shuffle and each is shuffled once, however many frames
    there are, and no key of a full outer join can grow hot (the adaptive skew join cannot
    split that join type). A key that occurs twice in one frame fails the job; such frames
    need ``full_align``. NULL keys group together here, while a join would keep them apart.

    ``cluster_by``, a part of ``on``, partitions the rows by those columns only. The grouping
    and later windows over them then share that one exchange.
    """
    shared = [*on, *describe]
    metrics = [[c for c in df.columns if c not in shared] for df in frames]
    stacked = union_drifted(
        *[
            df.select(
                *[F.col(quoted(c)) for c in on],
                *[F.col(quoted(c)).alias(_sided(c, i)) for c in describe],
                *[F.col(quoted(c)) for c in metrics[i]],
                F.lit(1).alias(_sided("seen", i)),
            )
            for i, df in enumerate(frames)
        ]
    )
    if cluster_by:
        stacked = stacked.repartition(*[F.col(quoted(c)) for c in cluster_by])
    values = [c for c in stacked.columns if c not in on and not c.startswith("seen__")]
    # In series order, so that the sort of the grouping serves later windows as well.
    grouped = stacked.groupBy(*cluster_by, *[c for c in on if c not in cluster_by]).agg(
        F.greatest(*[F.count(_sided("seen", i)) for i in range(len(frames))], F.lit(0)).alias("copies"),
        *[F.max(F.col(quoted(c))).alias(c) for c in values],
    )
    # A filter, so that the check holds whichever columns are read.
    complaint = F.raise_error(F.lit(f"stack_align: {list(on)} is not unique in a frame")).cast("boolean")
    grouped = grouped.filter(F.when(F.col("copies") > 1, complaint).otherwise(True))
    out = []
    for names in metrics:
        for m in names:
            value = F.col(quoted(m))
            out.append((value if fill is None else F.coalesce(value, F.lit(fill))).alias(m))
    return grouped.select(*on, *[_merged(c, len(frames)) for c in describe], *out)


def align_wide(
    frames: dict[str, DataFrame],
    on: Sequence[str],
    *,
    describe: Sequence[str],
    fill: int | None = 0,
    null_tolerant: Sequence[str] = (),
    coalesce_keys: bool = True,
    attributes: DataFrame | None = None,
    carry: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Unpivot metrics and join them on ``(dt, *on)``, for ``{metric: wide frame}``.

    When all frames have the same dates, which is how they are published, the wide rows are
    joined on ``on`` and the joined row is unpivoted. That gives the same rows, duplicates
    included, because a location has each date once. But a location crosses the network as
    one row with an array per metric instead of one described row per date, and the long
    rows come out already partitioned by ``on``, so that windows over it need no exchange.
    Frames with different dates are unpivoted first.

    ``attributes`` is left-joined on ``on`` and adds its other columns. ``carry`` takes columns
    from the rows of one metric's frame instead, NULL where it has none; that needs equal dates.
    """
    axes = {metric: date_columns(df.columns) for metric, df in frames.items()}
    place = [*on, *[c for c in describe if c not in on]]
    totals = [f"total_{metric}" for metric in frames]
    added = [] if attributes is None else [c for c in attributes.columns if c not in on]
    axis = next(iter(axes.values()))
    carry = carry or {}
    if any(other != axis for other in axes.values()) and carry:
        raise ValueError("carry needs frames with the same dates")
    if any(other != axis for other in axes.values()):
        aligned = full_align(
            [unpivot_wide(df, place, metric) for metric, df in frames.items()],
            on=["dt", *on],
            describe=[c for c in place if c not in on],
            fill=fill,
            null_tolerant=null_tolerant,
            coalesce_keys=coalesce_keys,
        )
        if attributes is not None:
            aligned = enrich(aligned, attributes, on, added)
        return aligned.select("dt", *place, *added, *totals)

    sides = [
        df.select(
            *[F.col(quoted(c)).alias(_sided(c, i)) for c in place],
            F.array(*axis).alias(_sided("values", i)),
            *carry.get(metric, ()),
        )
        for i, (metric, df) in enumerate(frames.items())
    ]
    carried = [c for columns in carry.values() for c in columns]
    joined = _outer_chain(sides, on, null_tolerant, coalesce_keys)
    blank = F.expr(f"array_repeat(CAST(NULL AS bigint), {len(axis)})")
    located = joined.select(
        *[_merged(c, len(frames)) for c in place],
        *[F.coalesce(_sided("values", i), blank).alias(t) for i, t in enumerate(totals)],
        *carried,
    ).repartition(*[F.col(quoted(c)) for c in on])
    if attributes is not None:
        located = enrich(located, attributes, on, added)
    added += carried
    days = day_literals([column_day(c) for c in axis])
    inline = F.inline_outer if axis else F.inline  # see unnest
    long = located.select(
        *place, *added, inline(F.arrays_zip(days.alias("dt"), *[F.col(t) for t in totals]))
    )
    filled = [F.col(t) if fill is None else F.coalesce(t, F.lit(fill)).alias(t) for t in totals]
    return long.select("dt", *place, *added, *filled)


def enrich(df: DataFrame, attributes: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """LEFT JOIN of attribute columns. A key that occurs k times on the right gives k rows.

    No broadcast hint: the planner broadcasts a side whose size it knows to be small, and
    otherwise joins on the partitioning by ``on``.
    """
    return df.join(attributes.select(*on, *cols), list(on), "left")


def asof_enrich(
    df: DataFrame, attributes: DataFrame, on: Sequence[str], cols: Sequence[str], order: str = "dt"
) -> DataFrame:
    """Attribute columns as of each row's day: from the latest attribute row of its key that is not
    later, NULL where there is none.

    Rows and attributes are stacked and sorted once by key and day, so a key needs no pairs of
    rows and days, and NULL in a key is a key like others. A NULL attribute is a value; of
    attribute rows of one key and day one is taken.
    """
    held = F.struct(*[F.col(quoted(c)) for c in cols])
    known = attributes.select(*on, order, held.alias("held__"), F.lit(0).alias("kind__"))
    rows = df.withColumns({"held__": F.lit(None).cast(known.schema["held__"].dataType), "kind__": F.lit(1)})
    window = Window.partitionBy(*[F.col(quoted(c)) for c in on]).orderBy(order, "kind__")
    latest = F.last("held__", ignorenulls=True).over(window)
    both = union_drifted(rows, known).withColumn("held__", latest).filter(F.col("kind__") == 1)
    return both.select(*[F.col(quoted(c)) for c in df.columns], "held__.*")


def union_sources(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; all frames have the same columns (pad with ``null_columns``)."""
    return reduce(DataFrame.unionByName, frames)


def union_drifted(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; a column that a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
