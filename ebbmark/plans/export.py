"""The batch export: every table of one batch, from its offset to its watermark."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from contextlib import nullcontext
from dataclasses import dataclass, replace
from typing import Any

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ebbmark.functions.clock import CLOCK_SHIFT_HOURS, batch_clock
from ebbmark.operators.delta import (
    INT_CHECK,
    TIMESTAMP_CHECK,
    Check,
    Stats,
    collect_stats,
    delta,
    has_files,
    in_files,
    split_bounds,
    stored_offset,
    union,
)
from ebbmark.operators.records import to_records
from ebbmark.sources.claims import Claim, Claims
from ebbmark.sources.control_log import LOG_SCHEMA, ControlTable, batch_number
from ebbmark.sources.scratch import remove, scratch_folder
from ebbmark.sources.sinks import RecordSink
from ebbmark.sources.tables import TableStore
from ebbmark.sources.zone_map import ZoneMap

# Tables whose stats share one job; bounds the size of its plan.
STATS_CHUNK = 50
OPEN_CONCURRENT = 8
# Rows a task sorts at once where records are dealt by ranges; a partition of more is written in steps.
SORT_ROWS = 2_000_000
# The name a sink gets for records of several tables.
TOGETHER = "all"

# A control row on its way through the driver: its offset chosen, the clocks
# left out as they are set anew, and what this batch found.
DRIVER_ROW = pa.schema(
    [
        ("tablename", pa.string()),
        ("typeid", pa.int32()),
        ("typename", pa.string()),
        ("checkcolumn", pa.string()),
        ("intoffset", pa.int32()),
        ("longoffset", pa.int64()),
        ("columntypeid", pa.int32()),
        ("cloumntypename", pa.string()),
        ("ordered", pa.bool_()),
        ("seq", pa.int64()),
        ("stored_offset", pa.int64()),
        ("max_offset", pa.int64()),
        ("delta_count", pa.int64()),
        ("started_millis", pa.int64()),
        ("ended_millis", pa.int64()),
    ]
)


@dataclass(frozen=True)
class TableResult:
    """What happened to one table of a batch."""

    table: str
    offset: int | None
    max_offset: int | None = None
    row_count: int = 0
    error: Exception | None = None


class BatchFailed(RuntimeError):
    """Some tables of a batch were not exported; their control rows stand."""

    def __init__(self, results: list[TableResult]):
        self.results = results
        failed = [r for r in results if r.error is not None]
        super().__init__("; ".join(f"{r.table}: {r.error}" for r in failed))


def wall_millis() -> int:
    return time.time_ns() // 1_000_000


def driver_rows(control: DataFrame) -> DataFrame:
    """Control rows as the driver needs them: no clocks, the stored offset chosen."""
    if "seq" not in control.columns:
        control = control.withColumn("seq", F.lit(0).cast("bigint"))
    chosen = control.withColumn("stored_offset", stored_offset())
    return chosen.drop("batchstart_ts", "batchend_ts", "currentbatchcount")


def advanced(shift_hours: int = CLOCK_SHIFT_HOURS) -> list[Column]:
    """Columns of control rows moved on to what a batch found.

    To be selected from :func:`driver_rows` with ``max_offset``,
    ``delta_count``, ``started_millis`` and ``ended_millis``. The offset field
    of the row's column type takes the watermark; an empty table keeps its
    offset. The batch start is a clock, except for timestamp checks, whose
    offset it is.
    """
    kind = F.col("columntypeid")
    reached = F.coalesce("max_offset", "stored_offset")
    start = F.when(kind == TIMESTAMP_CHECK, F.timestamp_micros(reached)).otherwise(
        batch_clock(F.col("started_millis"), shift_hours)
    )
    moved = {
        "batchstart_ts": start,
        "batchend_ts": batch_clock(F.col("ended_millis"), shift_hours),
        "intoffset": F.when(kind == INT_CHECK, reached.cast("int")).otherwise(F.col("intoffset")),
        "longoffset": F.when(
            kind.isin(TIMESTAMP_CHECK, INT_CHECK), F.col("longoffset")
        ).otherwise(reached),
        "currentbatchcount": F.col("delta_count"),
        "seq": F.coalesce("seq", F.lit(-1)) + 1,
    }
    return [
        moved[name].alias(name) if name in moved else F.col(name) for name in LOG_SCHEMA.names
    ]


@dataclass(frozen=True)
class _Form:
    """How the records of a batch look."""

    key_columns: Mapping[str, str]
    spread: int | None
    run_id: str | None
    ordered: int | None


@dataclass
class _Export:
    """One table on its way through a batch; ``delta_count`` is what was counted, then what was sent."""

    row: dict[str, Any]
    check: Check
    max_offset: int | None
    delta_count: int
    files: list[str] | None

    def rows(self, tables: TableStore) -> DataFrame:
        check = self.check
        bounds = split_bounds(check, self.max_offset) if tables.split else None
        if bounds:
            split = tables.read_split(check.frame.sparkSession, check.table, check.column, *bounds)
            check = replace(check, frame=split)
        # The watermark only narrows the rows further: their files hold them all.
        return in_files(delta(check, self.max_offset), self.files)

    def steps(self, form: _Form) -> int:
        """In how many steps a table dealt by ranges is written, for tasks that sort no more than ``SORT_ROWS``."""
        return 1 if form.ordered is None else max(1, -(-self.delta_count // (form.ordered * SORT_ROWS)))

    def records(self, form: _Form, tables: TableStore) -> DataFrame:
        rows = self.rows(tables)
        if form.ordered is not None:
            value = F.expr(self.check.value)
            rows = rows.repartitionByRange(form.ordered, value).sortWithinPartitions(value)
        records = self.encoded(rows, form)
        return records if form.ordered is None else records.withColumn("partition", F.spark_partition_id())

    def encoded(self, rows: DataFrame, form: _Form) -> DataFrame:
        check = self.check
        headers = None if form.run_id is None else {"run": f"'{form.run_id}'", "offset": check.as_offset(check.value)}
        return to_records(rows, check.table, form.key_columns.get(check.table), form.spread, headers)

    def stepwise(self, form: _Form, tables: TableStore, folder: str) -> Iterator[DataFrame]:
        """The records of a large table dealt by ranges, one frame per step, to be written one after the other.

        The ranges of the topic partitions are cut into as many parts as there are
        steps. A step has one part of every partition, in ascending order, and the
        parts of a partition follow one another, so that a partition ascends
        throughout while a task sorts one part. Rows of one check value share a part.
        The rows lie below ``folder`` by then, each read again once.
        """
        rows, parts = self.rows(tables), self.steps(form) * form.ordered
        value, offset = F.expr(self.check.value), F.expr(self.check.as_offset(self.check.value))
        cuts = rows.agg(F.percentile_approx(offset, [k / parts for k in range(1, parts)], 100 * parts).alias("cuts")).first().cuts
        row = F.struct(*(F.col(_named(c)) for c in rows.columns))
        told = rows.select(row.alias("row"), offset.alias("offset")).withColumn("part", F.expr(_part("offset", cuts)))
        dealt = told.withColumn("step", F.expr(f"part % {self.steps(form)}"))
        dealt.repartitionById(parts, F.col("part")).write.partitionBy("step").parquet(folder)
        back = rows.sparkSession.read.schema(dealt.schema).parquet(folder)
        for step in range(self.steps(form)):
            partition = F.expr(f"CAST(part div {self.steps(form)} AS INT)")
            one = back.filter(F.col("step") == step).select("row", partition.alias("partition"))
            one = one.repartitionById(form.ordered, F.col("partition")).select("row.*")
            yield self.encoded(one.sortWithinPartitions(value), form).withColumn("partition", F.spark_partition_id())

    def found(self, ended_millis: int) -> dict[str, Any]:
        return {
            **self.row,
            "max_offset": self.max_offset,
            "delta_count": self.delta_count,
            "ended_millis": ended_millis,
        }

    def result(self, error: Exception | None = None) -> TableResult:
        count = 0 if error else self.delta_count
        return TableResult(self.check.table, self.check.offset, self.max_offset, count, error)


def _named(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _part(offset: str, cuts: Sequence[int], first: int = 0) -> str:
    """SQL for the number of cuts below an offset, by halves."""
    if not cuts:
        return str(first)
    half = len(cuts) // 2
    low, high = _part(offset, cuts[:half], first), _part(offset, cuts[half + 1 :], first + half + 1)
    return f"IF({offset} <= {cuts[half]}L, {low}, {high})"


def open_checks(
    spark: SparkSession,
    rows: Sequence[dict[str, Any]],
    tables: TableStore,
    from_start: bool,
) -> list[Check | Exception]:
    """A check per control row, or what is wrong with the row or its table.

    Opening a table lists its files and reads a schema, so several are opened
    at a time.
    """

    def open_one(row: dict[str, Any]) -> Check | Exception:
        try:
            return Check(
                row["tablename"],
                tables.read(spark, row["tablename"]),
                row["checkcolumn"],
                row["columntypeid"],
                row["stored_offset"],
                from_start,
            )
        except Exception as error:
            return error

    with ThreadPoolExecutor(OPEN_CONCURRENT) as pool:
        return [*pool.map(inheritable_thread_target(spark)(open_one), rows)]


def export_stats(
    spark: SparkSession, checks: Sequence[Check], zones: ZoneMap | None = None
) -> list[Stats | Exception]:
    """Stats of all checks in one job; if that job fails, of each on its own, several at a time.

    With ``zones`` the stats of tables in files come from the zone map, table by
    table, as each appends what it has read.
    """

    def alone(check: Check) -> Stats | Exception:
        try:
            return collect_stats([check])[0]
        except Exception as error:
            return error

    def zoned(check: Check) -> Stats | Exception:
        try:
            return zones.stats(spark, check)
        except Exception as error:
            return error

    if zones is not None:
        mapped = {i: zoned(check) for i, check in enumerate(checks) if has_files(check.frame)}
        rest = [check for i, check in enumerate(checks) if i not in mapped]
        others = iter(export_stats(spark, rest) if rest else [])
        return [mapped[i] if i in mapped else next(others) for i in range(len(checks))]
    try:
        return [*collect_stats(checks)]
    except Exception as error:
        if len(checks) == 1:
            return [error]
    with ThreadPoolExecutor(OPEN_CONCURRENT) as pool:
        return [*pool.map(inheritable_thread_target(spark)(alone), checks)]


def _prepare(
    spark: SparkSession,
    rows: Sequence[dict[str, Any]],
    tables: TableStore,
    from_start: bool,
    zones: ZoneMap | None,
) -> tuple[list[_Export], list[TableResult]]:
    opened = list(zip(rows, open_checks(spark, rows, tables, from_start)))
    failed = [
        TableResult(row["tablename"], row["stored_offset"], error=check)
        for row, check in opened
        if isinstance(check, Exception)
    ]
    ready = []
    for row, check in opened:
        if isinstance(check, Check) and check.offset is None and not from_start:
            # Nothing could be sent, and advancing would lose every row so far.
            missing = ValueError("no offset: store one (0 for a new table) or pass from_start")
            failed.append(TableResult(check.table, None, error=missing))
        elif isinstance(check, Check):
            ready.append((row, check))
    exports = []
    for (row, check), stats in zip(ready, export_stats(spark, [c for _, c in ready], zones) if ready else []):
        if isinstance(stats, Stats) and not stats.exact:
            stats = ValueError(
                f"the largest {check.column} is a local time the session time zone "
                "skips; use a zone without clock changes, such as UTC"
            )
        if isinstance(stats, Exception):
            failed.append(TableResult(check.table, check.offset, error=stats))
        else:
            exports.append(_Export(row, check, stats.max_offset, stats.delta_count, stats.files))
    return exports, failed


def export_batch(
    spark: SparkSession,
    batch_id: int | str,
    control: ControlTable,
    tables: TableStore,
    sink: RecordSink,
    *,
    from_start: bool = False,
    key_columns: Mapping[str, str] | None = None,
    spread: int | None = None,
    shift_hours: int = CLOCK_SHIFT_HOURS,
    single_write: bool = False,
    write_group: int = STATS_CHUNK,
    zones: ZoneMap | None = None,
    claims: Claims | None = None,
    run_id: str | None = None,
    ordered: int | None = None,
    clock: Callable[[], int] = wall_millis,
) -> list[TableResult]:
    """Export the new rows of every table of a batch, then advance its control rows.

    The rows sent are those from the stored offset to the largest check value,
    both included, so a batch on unchanged data sends the last rows again.
    A control row is advanced after its rows are written: delivery is
    at-least-once. A table that fails keeps its control row, the others go on,
    and :class:`BatchFailed` is raised at the end.

    A table without an offset fails, unless ``from_start`` makes a null offset
    mean "everything". ``key_columns`` names the column whose value keys the
    records of a table; tables not named there have their name as key.
    ``spread`` deals the records of every table over that many topic partitions
    by a hash of the row, whatever their key. ``single_write`` sends up to
    ``write_group`` tables in one job, which is quicker for many small tables,
    but one failure then holds back the whole group. ``zones`` takes the stats of
    tables in files from a zone map, so that only files not seen before are read
    for them. ``claims`` holds the batch for the time of the run: a second run of
    it stops with ``BatchClaimed``, and none advances a control row after its
    lease. The count of a control row is that of the records handed to the sink.
    With a ``run_id`` every record has headers, ``run`` and ``offset``, its check
    value, by which :func:`~ebbmark.operators.records.once` leaves out what was
    sent before. ``ordered`` deals every table by ranges of its check column over
    that many topic partitions, each in ascending order; it shuffles the rows. Where
    that leaves a task more than ``SORT_ROWS`` rows, they are stored below the
    scratch folder and sent in steps, range after range of every partition.
    """
    if write_group < 1:
        raise ValueError("a write group has one table at least")
    if run_id is not None and not re.fullmatch(r"[\w.:-]+", run_id):
        raise ValueError("a run id has letters, digits and _ . : - only")
    if ordered is not None and spread is not None:
        raise ValueError("records are dealt by a hash or by ranges, not by both")
    form = _Form(key_columns or {}, spread, run_id, ordered)
    holding = nullcontext() if claims is None else claims.hold(spark, batch_number(batch_id))
    with holding as claim:
        return _export(
            spark, batch_id, control, tables, sink, from_start, form, shift_hours,
            single_write, write_group, zones, claim, clock,
        )


def _export(
    spark: SparkSession,
    batch_id: int | str,
    control: ControlTable,
    tables: TableStore,
    sink: RecordSink,
    from_start: bool,
    form: _Form,
    shift_hours: int,
    single_write: bool,
    write_group: int,
    zones: ZoneMap | None,
    claim: Claim | None,
    clock: Callable[[], int],
) -> list[TableResult]:
    # One row per table of the batch: what the driver needs to start the jobs.
    rows = driver_rows(control.current(spark, batch_id)).toArrow().to_pylist()
    rows.sort(key=lambda row: row["tablename"] or "")
    moved = advanced(shift_hours)
    results: list[TableResult] = []
    running: dict[Future, list[_Export]] = {}

    def write_steps(export: _Export) -> int:
        folder, sent = scratch_folder(spark), 0
        try:
            for records in export.stepwise(form, tables, folder):
                counted = Observation()
                records = records.observe(counted, F.count(F.lit(1)).alias("sent"))
                sink.write(records, TOGETHER if single_write else export.check.table)
                sent += counted.get["sent"]
        finally:
            remove(spark, folder)
        return sent

    def write(unit: list[_Export]) -> list[dict[str, Any]]:
        in_steps = {id(export) for export in unit if export.steps(form) > 1}
        for export in unit:
            if id(export) in in_steps:
                export.delta_count = write_steps(export)
        counts = {id(export): Observation() for export in unit if export.delta_count and id(export) not in in_steps}
        sending = [export for export in unit if id(export) in counts]
        if sending:
            count = F.count(F.lit(1)).alias("sent")
            records = union(
                export.records(form, tables).observe(counts[id(export)], count)
                for export in sending
            )
            sink.write(records, TOGETHER if single_write else sending[0].check.table)
        ended = clock()
        for export in sending:
            export.delta_count = counts[id(export)].get["sent"]
        return [export.found(ended) for export in unit]

    def settle(done: Iterable[Future]) -> None:
        """Advance the control rows of finished writes, all in one append."""
        found = [row for f in done if f.exception() is None for row in f.result()]
        error = None
        if found:
            try:
                if claim is not None:
                    claim.confirm()
                arrived = spark.createDataFrame(pa.Table.from_pylist(found, DRIVER_ROW))
                control.append(arrived.select(*moved).coalesce(1))
            except Exception as not_saved:
                error = not_saved
        for future in done:
            unit = running.pop(future)
            results.extend(export.result(future.exception() or error) for export in unit)

    # Several tables are written at a time so that small ones do not idle the
    # cluster, and a large one does not hold up the tables after it. Control
    # rows are saved by this thread alone: saves never overlap.
    inheritable = inheritable_thread_target(spark)
    with ThreadPoolExecutor(1 if single_write else sink.concurrent) as pool:
        # A group that is written together is prepared together.
        step = max(STATS_CHUNK // write_group, 1) * write_group if single_write else STATS_CHUNK
        for first in range(0, len(rows), step):
            started = clock()
            chunk = rows[first : first + step]
            chunk_rows = [{**row, "started_millis": started} for row in chunk]
            exports, failed = _prepare(spark, chunk_rows, tables, from_start, zones)
            results += failed
            size = write_group if single_write else 1
            units = [exports[i : i + size] for i in range(0, len(exports), size)]
            running |= {pool.submit(inheritable(write), unit): unit for unit in units}
            settle([future for future in running if future.done()])
        while running:
            settle(wait(running, return_when=FIRST_COMPLETED).done)
    if any(r.error is not None for r in results):
        raise BatchFailed(results)
    return results
