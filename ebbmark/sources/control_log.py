"""The control table: one row per exported table and batch."""

from __future__ import annotations

import functools
import operator
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbmark.sources.tables import TableStore

# Field names, their order and types are those of existing
# control tables. "cloumntypename" is spelled as it is there.
CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("tablename", T.StringType()),
        T.StructField("batchstart_ts", T.TimestampType()),
        T.StructField("batchend_ts", T.TimestampType()),
        T.StructField("typeid", T.IntegerType()),
        T.StructField("typename", T.StringType()),
        T.StructField("checkcolumn", T.StringType()),
        T.StructField("intoffset", T.IntegerType()),
        T.StructField("longoffset", T.LongType()),
        T.StructField("columntypeid", T.IntegerType()),
        T.StructField("cloumntypename", T.StringType()),
        T.StructField("currentbatchcount", T.LongType()),
        T.StructField("ordered", T.BooleanType()),
    ]
)
LOG_SCHEMA = T.StructType([*CONTROL_SCHEMA.fields, T.StructField("seq", T.LongType())])
KEY = ["typeid", "tablename"]
POINTERS = "generation bigint, log string, previous string"


def conform(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema``, taken by name and cast."""
    return frame.selectExpr(
        *(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema)
    )


def batch_number(value: int | str) -> int:
    """A batch id as an int; text that is more than digits is refused."""
    if isinstance(value, str):
        if not re.fullmatch(r"\s*[+-]?[0-9]+\s*", value):
            raise ValueError(f"batch id must be an integer, not {value!r}")
        return int(value)
    return operator.index(value)


def select_batch(control: DataFrame, batch_id: int | str) -> DataFrame:
    """Control rows of one batch."""
    return control.filter(F.col("typeid") == F.lit(batch_number(batch_id)))


def latest(log: DataFrame) -> DataFrame:
    """The row with the highest ``seq`` of every ``(typeid, tablename)``.

    ``max_by`` is combined before the shuffle, so each task sends one row per
    key however many versions a key has. Filters on the key reach the scan.
    ``seq`` is meant to be unique within a key; a row without one comes first.
    """
    state = [c for c in log.columns if c not in KEY]
    newest = F.max_by(F.struct(*state), F.coalesce("seq", F.lit(-1))).alias("state")
    return log.groupBy(*KEY).agg(newest).select(*KEY, "state.*").select(*log.columns)


@dataclass(frozen=True)
class ControlTable:
    """Control state in a :class:`TableStore`.

    ``versioned=True`` is an append-only log with a ``seq`` column, for stores
    whose append adds rows. ``versioned=False`` is for stores whose append
    replaces the row with the same key (Kudu): no ``seq``, one row per key.

    ``manifest`` names a table that says which log is the current one, so that
    ``compact`` needs no change in the caller: reads and appends follow it. A
    read also takes in the log before the current one, as a run may have looked
    the name up just before a compaction and append there after it; a run must
    not stay out over two compactions.
    """

    store: TableStore
    name: str
    versioned: bool = True
    manifest: str | None = None

    @property
    def schema(self) -> T.StructType:
        return LOG_SCHEMA if self.versioned else CONTROL_SCHEMA

    def read(self, spark: SparkSession) -> DataFrame:
        _, current, before = self._logs(spark)
        logs = [conform(self.store.read(spark, name), self.schema) for name in [*current, *before]]
        return functools.reduce(DataFrame.unionAll, logs)

    def current(self, spark: SparkSession, batch_id: int | str | None = None) -> DataFrame:
        """Current state, of one batch if an id is given."""
        rows = self.read(spark)
        if batch_id is not None:
            rows = select_batch(rows, batch_id)
        return latest(rows) if self.versioned else rows

    def append(self, rows: DataFrame) -> None:
        _, current, _ = self._logs(rows.sparkSession)
        self.store.append(conform(rows, self.schema), current[0])

    def _logs(self, spark: SparkSession) -> tuple[int, list[str], list[str]]:
        """The generation of the log, its name, and the name of the one before.

        More than one of either where compactions ran at the same time.
        """
        pointers = None if self.manifest is None else self.store.read_if_there(spark, self.manifest)
        if pointers is None:
            return 0, [self.name], []
        # One row per compaction that ran last: one, as a rule.
        last = pointers.groupBy("generation").agg(
            F.array_sort(F.collect_set("log")).alias("logs"), F.collect_set("previous").alias("before")
        )
        newest = last.orderBy(F.desc("generation")).first()
        return newest.generation, newest.logs, sorted(set(newest.before) - set(newest.logs))

    def compact(self, spark: SparkSession) -> None:
        """Write the current state to a new log and make it the current one.

        The old log stays as it is. Reads before, while and after give one state.
        """
        if self.manifest is None or not self.versioned:
            raise ValueError("only a log with a manifest can be compacted in place")
        generation, current, _ = self._logs(spark)
        log = f"{self.name}_{generation + 1}_{uuid.uuid4().hex[:8]}"
        self.store.create(conform(self.current(spark), self.schema), log)
        rows = [(generation + 1, log, name) for name in current]
        self.store.append(spark.createDataFrame(rows, POINTERS).coalesce(1), self.manifest)

    def compact_into(self, spark: SparkSession, target: ControlTable) -> None:
        """Write the current state to a new table and leave this one as it is.

        Run it between batches and point the next batch at ``target``.
        """
        target.store.create(conform(self.current(spark), target.schema), target.name)
