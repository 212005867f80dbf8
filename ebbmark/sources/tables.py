"""Named tables behind any Spark reader."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

CATALOG = "table"


@dataclass(frozen=True)
class Split:
    """Reader options that have a table read by several tasks, split by a column.

    The names are those of the JDBC reader, which without them reads any table
    in one task. ``parts`` is the number of tasks, and of connections at a time.
    """

    parts: int
    column: str = "partitionColumn"
    lower: str = "lowerBound"
    upper: str = "upperBound"
    count: str = "numPartitions"

    def options(self, column: str, lower: str, upper: str) -> dict[str, str]:
        return {self.column: column, self.lower: lower, self.upper: upper, self.count: str(self.parts)}


@dataclass(frozen=True)
class TableStore:
    """A family of tables that share a format and options and differ by name.

    ``name_option`` is the reader option that carries the table, and
    ``name_value`` how the name is spelled in it:

    - files: ``TableStore("parquet", name_value="/lake/{table}")``
    - Kudu: ``TableStore("kudu", {"kudu.master": m}, name_option="kudu.table")``
    - JDBC: ``TableStore("jdbc", {"url": u}, name_option="dbtable", split=Split(32))``
    - metastore: ``TableStore("table")``
    """

    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    name_option: str = "path"
    name_value: str = "{table}"
    split: Split | None = None

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        name = self.name_value.format(table=table)
        if self.format == CATALOG:
            # A session keeps the file lists of metastore tables; other jobs add files.
            spark.catalog.refreshTable(name)
            return spark.read.options(**self.options).table(name)
        reader = spark.read.format(self.format).options(**self.options)
        return reader.option(self.name_option, name).load()

    def read_if_there(self, spark: SparkSession, table: str) -> DataFrame | None:
        """The table, or ``None`` where it has not been written yet."""
        try:
            return self.read(spark, table)
        except AnalysisException as error:
            if not re.search("PATH_NOT_FOUND|TABLE_OR_VIEW_NOT_FOUND", str(error)):
                raise
            return None

    def read_split(self, spark: SparkSession, table: str, column: str, lower: str, upper: str) -> DataFrame:
        """The whole table, read by ``split.parts`` tasks that share the values from ``lower`` to ``upper``.

        Without ``split`` the table is read as ever. Rows outside the bounds are
        read too, by the first and the last task: the bounds deal rows out, they
        drop none.
        """
        if self.split is None:
            return self.read(spark, table)
        bounds = self.split.options(column, lower, upper)
        return replace(self, options={**self.options, **bounds}).read(spark, table)

    def append(self, rows: DataFrame, table: str) -> None:
        self._save(rows.write.mode("append"), table)

    def create(self, rows: DataFrame, table: str) -> None:
        """Write a table that must not exist yet."""
        self._save(rows.write.mode("errorifexists"), table)

    def _save(self, writer: DataFrameWriter, table: str) -> None:
        name = self.name_value.format(table=table)
        writer = writer.options(**self.options)
        if self.format == CATALOG:
            writer.saveAsTable(name)
        else:
            writer.format(self.format).option(self.name_option, name).save()


def view_name(table: str) -> str:
    """A temp view name for a table name such as ``db.t`` or ``store::db.t``, another for every table.

    Lower-case ASCII letters, and digits after the first character, stand for
    themselves, ``_`` is doubled and anything else becomes its code point
    between underscores: ``a.b`` is ``a_2e_b``. Upper case counts as anything
    else, as view names ignore case.
    """
    escape = lambda m: "__" if m[0] == "_" else f"_{ord(m[0]):x}_"
    return re.sub(r"^[0-9]|[^a-z0-9]", escape, table) or "_"


def register_view(frame: DataFrame, table: str) -> str:
    """Make a table readable from ``spark.sql``; returns the view name."""
    name = view_name(table)
    frame.createOrReplaceTempView(name)
    return name
