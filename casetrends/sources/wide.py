"""Wide time-series CSV: leading location columns, then one column per date."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrends.functions.casts import MODES, sql_text, typed_sql
from casetrends.functions.dates import column_day, date_columns, date_header
from casetrends.operators.align import union_drifted
from casetrends.operators.project import quoted
from casetrends.sources.files import exact, read_text_csv
from casetrends.sources.headers import file_headers, header_groups, split_header

RECORD, FIELDS = "record__", "fields__"


def _wide_groups(
    spark: SparkSession, path: str, ids: T.StructType, sep: str
) -> Iterator[tuple[DataFrame, list[str]]]:
    """The rows of each header and its date columns. Ids are text, counts BIGINT; ``record__`` is
    the text of a row that has something else in a count, or another number of fields."""
    groups = header_groups(file_headers(spark, [exact(path)], sep))
    if not groups:
        raise FileNotFoundError(f"no CSV data below {path}")
    for group in groups:
        if len(group.header) < len(ids):
            raise ValueError(
                f"{group.example}: {len(group.header)} columns, at least {len(ids)} expected"
            )
        dates = [date_header(h) for h in group.header[len(ids) :]]
        if len(set(dates)) < len(dates):
            raise ValueError(f"{group.example}: a date occurs twice in the header")
        raw = read_text_csv(
            spark, [exact(path)], group, sep, counts_from=len(ids), corrupt=RECORD, whole_rows=True
        )
        yield raw.toDF(*ids.names, *dates, RECORD, "file_path"), dates


def _fields(raw: DataFrame, sep: str, dates: list[str]) -> DataFrame:
    """The rows with ``fields__``, the texts of those that don't fit; NULL for the others.

    The reader looks only at columns that are asked for, so this asks for all counts.
    """
    line = F.regexp_replace(RECORD, "[\r\n]+$", "")
    misfit = F.col(RECORD).isNotNull()
    if dates:
        least = F.coalesce(F.array_min(F.array(*dates)), F.lit(0))
        misfit &= least >= F.lit(-(2**63) + 1)
    return raw.withColumn(FIELDS, F.when(misfit, split_header(line, sep)))


# Of one field ``x`` of a row that doesn't fit.
PARSED = typed_sql("x", T.LongType(), "permissive")
BAD = f"{typed_sql('x', T.StringType())} IS NOT NULL AND {PARSED} IS NULL"


def _counts(ids: T.StructType, dates: list[str], mode: str) -> Column:
    """All counts of a row as one array, so that a row is parsed whole whichever of them are read."""
    texts = f"slice({FIELDS}, {len(ids) + 1}, {len(dates)})"
    count = PARSED
    if mode == "strict":
        names = ", ".join(map(sql_text, dates))
        complaint = f"concat(element_at(array({names}), i + 1), ': not a bigint: ', x)"
        count = f"CASE WHEN {BAD} THEN raise_error({complaint}) ELSE {PARSED} END"
        width = f"concat('malformed row, ', size({FIELDS}), ' fields: ', {RECORD})"
        texts = (
            f"CASE WHEN size({FIELDS}) = {len(ids) + len(dates)} THEN {texts} ELSE raise_error({width}) END"
        )
    return F.expr(
        f"CASE WHEN {RECORD} IS NULL THEN array({', '.join(dates)})"
        f" ELSE transform({texts}, (x, i) -> {count}) END"
    )


def read_wide(
    spark: SparkSession, path: str, ids: T.StructType, mode: str = "strict", sep: str = ","
) -> DataFrame:
    """Read wide files below ``path``: ``ids`` by position, ``dt_YYYYMMDD`` columns by name.

    Dates come from each file's own header, so files that end on different days go together;
    a date that a file lacks is NULL for its rows. Headers are found by tasks; files are split
    among tasks unless a quoted field of theirs holds a line break.

    The CSV reader itself parses the counts, several times faster than a thousand cast
    expressions. Rows in which it finds anything but digits or an empty field, and only these, go
    through the casts of texts: ``12.0`` is 12 and ``NA`` is NULL. What is no count then, or a row with
    another number of fields, fails the job in the strict mode; in the permissive mode such a count
    is NULL, and ``wide_rejects`` lists it.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    frames = []
    for raw, dates in _wide_groups(spark, path, ids, sep):
        located = [
            f"{typed_sql(quoted(f.name), f.dataType, mode, f.name)} AS {quoted(f.name)}"
            for f in ids.fields
        ]
        rows = _fields(raw, sep, dates).withColumn("counts__", _counts(ids, dates, mode))
        frames.append(
            rows.selectExpr(*located, *[f"get(counts__, {k}) AS {d}" for k, d in enumerate(dates)])
        )
    everything = union_drifted(*frames)
    return everything.select(*[quoted(c) for c in ids.names], *date_columns(everything.columns))


def wide_rejects(spark: SparkSession, path: str, ids: T.StructType, sep: str = ",") -> DataFrame:
    """``file_path, record, column, text``: each field that is no value of its column, with the ids of
    its row as ``record``; ``column`` is NULL where the row has another number of fields, with the
    row as ``text``."""
    frames = []
    for raw, dates in _wide_groups(spark, path, ids, sep):
        whole = len(ids) + len(dates)
        n = f"CASE WHEN size({FIELDS}) <> {whole} THEN array(named_struct('column', CAST(NULL AS string), 'text', {RECORD})) END"
        names = ", ".join(map(sql_text, dates))
        counts = (
            f"filter(transform(slice({FIELDS}, {len(ids) + 1}, {len(dates)}), (x, i) -> "
            f"CASE WHEN {BAD} THEN named_struct('column', element_at(array({names}), i + 1), 'text', x) END),"
            " s -> s IS NOT NULL)"
        )
        places = [
            f"CASE WHEN {typed_sql(quoted(f.name), T.StringType())} IS NOT NULL"
            f" AND {typed_sql(quoted(f.name), f.dataType, 'permissive')} IS NULL"
            f" THEN named_struct('column', {sql_text(f.name)}, 'text', {quoted(f.name)}) END"
            for f in ids.fields
        ]
        empty = "array()"
        found = (
            f"concat(coalesce({n}, {empty}), coalesce({counts}, {empty}),"
            f" filter(array({', '.join(places)}), s -> s IS NOT NULL))"
        )
        record = f"concat_ws({sql_text(sep)}, {', '.join(quoted(c) for c in ids.names)})"
        frames.append(
            _fields(raw, sep, dates).selectExpr("file_path", f"{record} AS record", f"inline({found})")
        )
    return union_drifted(*frames)


def write_wide(df: DataFrame, path: str, ids: list[str], sep: str = ",") -> None:
    """Write a wide frame with ``m/d/yy`` date headers, the shape ``read_wide`` reads."""
    dates = date_columns(df.columns)
    days = [column_day(c) for c in dates]
    headers = [f"{d.month}/{d.day}/{d:%y}" for d in days]
    out = df.select(
        *[quoted(c) for c in ids], *[F.col(c).alias(h) for c, h in zip(dates, headers)]
    )
    out.write.mode("overwrite").option("header", True).option("sep", sep).option(
        "escape", '"'
    ).csv(path)
