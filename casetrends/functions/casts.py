"""Text to typed columns, strict (bad text fails the job) or permissive (bad text is NULL).

The expressions are built as SQL text, one parse per column: a wide file has a thousand date
columns, and assembling each cast from Column objects would take longer than reading it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field texts that the usual CSV readers of these files take as "missing".
NA_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Date-time spellings tried in this order.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yy H:mm",
    "yyyy-MM-dd",
)

MODES = ("strict", "permissive")


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


_NA_LIST = ", ".join(map(sql_text, NA_TEXTS))


def _whole(number: str) -> str:
    return f"CASE WHEN {number} = floor({number}) THEN try_cast({number} AS bigint) END"


def _timestamp(text: str, formats: tuple[str, ...]) -> str:
    return f"coalesce({', '.join(f'try_to_timestamp({text}, {sql_text(f)})' for f in formats)})"


def typed_sql(text: str, dtype: T.DataType, mode: str = "strict", label: str = "value") -> str:
    """SQL of the cast of ``text``, itself SQL of a string (a quoted column name, usually)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    given = f"{text} NOT IN ({_NA_LIST})"
    name = dtype.simpleString()
    if isinstance(dtype, T.StringType):
        return f"CASE WHEN {given} THEN {text} END"
    if isinstance(dtype, T.TimestampType):
        parsed = _timestamp(text, TIMESTAMP_FORMATS)
    elif isinstance(dtype, T.LongType):
        parsed = _whole(f"try_cast({text} AS double)")
    else:
        parsed = f"try_cast({text} AS {name})"
    if mode == "strict":
        complaint = f"concat({sql_text(f'{label}: not a {name}: ')}, {text})"
        parsed = f"coalesce({parsed}, raise_error({complaint}))"
    checked = f"CASE WHEN {given} THEN {parsed} END"
    if isinstance(dtype, T.LongType):
        # Nearly all counts are plain digits; the rest is looked at only when that fails.
        return f"coalesce(try_cast({text} AS bigint), {checked})"
    return checked


def typed(text: str, dtype: T.DataType, mode: str = "strict", label: str = "value") -> Column:
    """Cast a text; ``label`` names it in the error of the strict mode."""
    return F.expr(typed_sql(text, dtype, mode, label))


def blank_to_null(text: str) -> Column:
    return typed(text, T.StringType())


def whole_to_long(number: str) -> Column:
    """A double that holds a whole number as BIGINT; NULL when it has a fraction."""
    return F.expr(_whole(number))


def parse_timestamp(text: str, formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> Column:
    return F.expr(_timestamp(text, formats))
