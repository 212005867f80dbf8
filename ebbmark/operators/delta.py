"""Check columns: offsets, watermarks and the rows between them.

An offset is a bigint whatever the check column's type: the value itself for
int and long columns, microseconds since the epoch for timestamps. It is
turned back into a literal of the column's own type before it is compared, so
that the comparison reaches the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import zip_longest
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column type ids of control rows. Any other id means long.
TIMESTAMP_CHECK = 0
INT_CHECK = 1


def check_types(type_id: int) -> tuple[type[T.DataType], ...]:
    """Column types a control row's ``columntypeid`` admits."""
    if type_id == TIMESTAMP_CHECK:
        return (T.TimestampType, T.TimestampNTZType)
    if type_id == INT_CHECK:
        return (T.IntegerType,)
    return (T.LongType,)


def stored_offset() -> Column:
    """The offset of a control row, from the field its ``columntypeid`` names."""
    return (
        F.when(F.col("columntypeid") == TIMESTAMP_CHECK, F.unix_micros("batchstart_ts"))
        .when(F.col("columntypeid") == INT_CHECK, F.col("intoffset").cast("bigint"))
        .otherwise(F.col("longoffset"))
    )


@dataclass(frozen=True)
class Check:
    """A table, its check column and the offset reached so far.

    A null offset selects nothing unless ``from_start`` is set, which then
    takes every row that has a check value.

    Conditions are SQL texts: a batch plans many tables, and a text costs the
    driver one call where a column expression costs one per step.
    """

    table: str
    frame: DataFrame
    column: str
    type_id: int
    offset: int | None
    from_start: bool = False

    def __post_init__(self) -> None:
        admitted = check_types(self.type_id)
        if not isinstance(self.data_type, admitted):
            names = " or ".join(t.typeName() for t in admitted)
            raise TypeError(
                f"{self.table}.{self.column} is {self.data_type.simpleString()}, "
                f"but columntypeid {self.type_id} needs {names}"
            )

    @cached_property
    def value(self) -> str:
        """The check column, quoted; one that is no column of the table is a nested field."""
        if self.column in self.frame.columns:
            return "`" + self.column.replace("`", "``") + "`"
        if "`" in self.column:
            return self.column
        return ".".join(f"`{part}`" for part in self.column.split("."))

    @cached_property
    def data_type(self) -> T.DataType:
        for field in self.frame.schema:
            if field.name == self.column:
                return field.dataType
        # Also where a name that is neither column nor field is refused.
        return self.frame.select(F.col(self.value)).schema[0].dataType

    def literal(self, offset: int) -> str:
        """An offset as a constant of the check column's type."""
        kind = self.data_type.simpleString()
        if self.type_id == TIMESTAMP_CHECK:
            return f"CAST(timestamp_micros({int(offset)}) AS {kind})"
        return f"CAST({int(offset)} AS {kind})"

    @property
    def at_or_past(self) -> str:
        """Condition for rows at or past the offset; never true for a null check value."""
        if self.offset is not None:
            return f"{self.value} >= {self.literal(self.offset)}"
        return f"{self.value} IS NOT NULL" if self.from_start else "false"

    def as_offset(self, value: str) -> str:
        if self.type_id == TIMESTAMP_CHECK:
            return f"unix_micros(CAST({value} AS TIMESTAMP))"
        return f"CAST({value} AS BIGINT)"

    def exact(self, value: str) -> str:
        """Whether a check value comes back unchanged from being an offset.

        Only a local time the session zone skips over (a clock change) does not.
        """
        if isinstance(self.data_type, T.TimestampNTZType):
            return f"CAST(CAST({value} AS TIMESTAMP) AS TIMESTAMP_NTZ) <=> {value}"
        return "true"


def delta(check: Check, upper: int | None = None) -> DataFrame:
    """Rows at or past the stored offset, up to ``upper`` if it is given."""
    rows = check.frame.filter(check.at_or_past)
    return rows if upper is None else rows.filter(f"{check.value} <= {check.literal(upper)}")


def split_bounds(check: Check, upper: int | None) -> tuple[str, str] | None:
    """First and last value of a delta as texts a split read takes; None where there is nothing to split.

    Timestamps are local times of the session's zone. The last bound is one past
    the largest value, for strides of equal width.
    """
    if upper is None or check.offset is None or upper <= check.offset:
        return None
    if check.type_id != TIMESTAMP_CHECK:
        return str(check.offset), str(upper + 1)
    spark = check.frame.sparkSession
    texts = (f"CAST(CAST(timestamp_micros({int(v)}) AS TIMESTAMP) AS STRING)" for v in (check.offset, upper + 1))
    return tuple(spark.range(1).selectExpr(*texts).first())


def stride_counts(check: Check, upper: int, parts: int) -> DataFrame:
    """Rows of a delta in each of the ``parts`` strides a split read deals it into: ``part, row_count``.

    Shows, before a large read, whether the check column spreads its rows. The
    strides are of equal width from the offset to ``upper``; parts without rows
    are not listed.
    """
    if check.offset is None:
        raise ValueError("a split needs an offset")
    width = max(1, -(-(upper + 1 - check.offset) // parts))
    part = F.expr(f"({check.as_offset(check.value)} - {int(check.offset)}) div {width}").cast("int")
    return delta(check, upper).groupBy(part.alias("part")).agg(F.count("*").alias("row_count"))


def has_files(frame: DataFrame) -> bool:
    """Whether rows know the file they come from; settled by analysis, nothing runs."""
    try:
        return frame.select("_metadata.file_path").columns == ["file_path"]
    except AnalysisException:
        return False


def in_files(rows: DataFrame, paths: Iterable[str] | None) -> DataFrame:
    """The same rows of a delta, read only from the files that hold them.

    Within parquet files nothing is skipped by ``timestamp_ntz`` or INT96
    values; with the files named, the others stay unopened when all columns are
    read. Any number of files can be named: the driver holds the file list of
    the table already, so the paths are bounded by what it keeps anyway.
    ``None`` means that the files are not known.
    """
    if paths is None:
        return rows
    named = ", ".join("'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'" for path in sorted(paths))
    return rows.filter(f"_metadata.file_path IN ({named})") if named else rows.filter("false")


def union(frames: Iterable[DataFrame]) -> DataFrame:
    """Union in order, by halves: Spark checks the plan again at every step."""
    frames = [*frames]
    while len(frames) > 1:
        pairs = zip_longest(frames[::2], frames[1::2])
        frames = [left.unionAll(right) if right is not None else left for left, right in pairs]
    return frames[0]


def _stats_of(check: Check, rows: DataFrame, count: str, label: str | None, files: str | None = None) -> DataFrame:
    # The conversions come after the maximum: once per table, not per row.
    top = f"max({check.value})"
    paths = [] if files is None else [F.expr(f"{files} AS files")]
    return rows.select(
        F.lit(check.table if label is None else label).alias("tablename"),
        F.expr(f"{check.as_offset(top)} AS max_offset"),
        F.expr(f"{count} AS delta_count"),
        F.expr(f"{check.exact(top)} AS exact"),
        *paths,
    )


def table_stats(check: Check, label: str | None = None) -> DataFrame:
    """Largest check value and delta size of a whole table, in one pass.

    Reads one column; each task sends one row to the shuffle.
    """
    return _stats_of(check, check.frame, f"count_if({check.at_or_past})", label)


def delta_stats(check: Check, label: str | None = None) -> DataFrame:
    """Like :func:`table_stats`, but reads only rows at or past the offset.

    The filter reaches the scan, so files and row groups below the offset are
    skipped. ``max_offset`` is null where the delta is empty.
    """
    return _stats_of(check, check.frame.filter(check.at_or_past), "count(*)", label)


def file_stats(check: Check, label: str | None = None) -> DataFrame:
    """Like :func:`delta_stats`, with ``files``, the files that hold rows of a timestamp delta.

    Null for other checks, whose comparison skips files by itself, and for
    sources without files. Combined per task: a path for each file it read.
    """
    files = "CAST(NULL AS ARRAY<STRING>)"
    if check.type_id == TIMESTAMP_CHECK and has_files(check.frame):
        files = "collect_set(_metadata.file_path)"
    return _stats_of(check, check.frame.filter(check.at_or_past), "count(*)", label, files)


class Stats(NamedTuple):
    table: str
    max_offset: int | None
    delta_count: int
    exact: bool
    # Files that hold rows of the delta, where they are worth naming.
    files: list[str] | None = None


def footer_frame(check: Check) -> DataFrame | None:
    """Largest value and number of values of a whole parquet table, ``(largest, n)``, out of its footers.

    Spark takes both from the files' footers, without reading a row, if the
    aggregate reaches its newer parquet source; a session of its own has that
    switched on. The files are those the check's frame has, so that no file that
    came later counts. ``None`` where footers do not tell: other formats,
    timestamps, nested fields, partition columns.
    """
    if check.type_id == TIMESTAMP_CHECK or check.column not in check.frame.columns:
        return None
    paths = [unquote(path) for path in check.frame.inputFiles()]
    if not paths or not all(path.endswith(".parquet") and not set(path) & set("*?[]{}\\") for path in paths):
        return None
    session = check.frame.sparkSession.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    rows = session.read.parquet(*paths)
    if {f.name: f.dataType for f in rows.schema}.get(check.column) != check.data_type:
        return None
    return rows.selectExpr(f"max({check.value}) AS largest", f"count({check.value}) AS n")


def collect_stats(checks: Sequence[Check]) -> list[Stats]:
    """Stats of every check, in order; at most two jobs for all of them, besides footers.

    Where rows at or past the offset exist, their largest check value is the
    table's. The few tables without any (emptied, or cut back below the
    offset) are then read whole for their maximum. Tables that are taken from
    their start, and those few, need no row read where footers tell.
    """
    found: dict[int, Stats] = {}

    def by_footers(places: Iterable[int], empty: bool) -> list[int]:
        """Takes what footers tell; gives the places they do not."""
        rest = []
        for i in places:
            frame = footer_frame(checks[i])
            if frame is None:
                rest.append(i)
            else:
                row = frame.first()
                found[i] = Stats(checks[i].table, row.largest, 0 if empty else row.n or 0, True)
        return rest

    def run(stats: Callable[[Check, str], DataFrame], places: Iterable[int]) -> None:
        for row in union(stats(checks[i], str(i)) for i in places).collect():
            place = int(row.tablename)
            found[place] = Stats(checks[place].table, *row[1:])

    whole = [i for i, check in enumerate(checks) if check.offset is None and check.from_start]
    rest = [*by_footers(whole, False), *(i for i in range(len(checks)) if i not in whole)]
    if rest:
        run(file_stats, rest)
    empty = by_footers([i for i in rest if found[i].delta_count == 0], True)
    if empty:
        run(table_stats, empty)
    return [found[i] for i in range(len(checks))]
