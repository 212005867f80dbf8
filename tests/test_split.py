"""Split reads, against a source of the test's own that takes the options of the JDBC reader."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ebbmark import Split, TableStore
from ebbmark.operators.delta import Check, split_bounds, stride_counts
from test_export import Setting, control_row

# Workers get the source by value: they cannot import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Strides(DataSource):
    """Numbers 0 to 99, dealt to tasks as the JDBC reader deals rows by its bounds."""

    @classmethod
    def name(cls):
        return "strides"

    def schema(self):
        return "id bigint, part int"

    def reader(self, schema):
        return StridesReader(dict(self.options))


class StridesReader(DataSourceReader):
    def __init__(self, options):
        # Option names reach a source in lower case.
        self.options = {k.lower(): v for k, v in options.items()}

    def partitions(self):
        parts = int(self.options.get("numpartitions", 1))
        return [InputPartition(k) for k in range(parts)]

    def read(self, partition):
        parts, low, high = (int(self.options.get(k, d)) for k, d in (("numpartitions", 1), ("lowerbound", 0), ("upperbound", 1)))
        assert self.options["name"] == "t" and self.options.get("partitioncolumn", "id") == "id"
        stride = max(1, (high - low) // parts)
        for i in range(100):
            if min(parts - 1, max(0, (i - low) // stride)) == partition.value:
                yield i, partition.value


@pytest.fixture
def store(spark):
    spark.dataSource.register(Strides)
    return TableStore("strides", name_option="name", split=Split(4))


def test_rows_are_the_same_in_many_tasks(spark, store):
    whole = store.read(spark, "t")
    split = store.read_split(spark, "t", "id", "40", "100")
    assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in split.collect()) == sorted(r.id for r in whole.collect())
    past = [r.part for r in split.filter("id >= 40").collect()]
    assert [past.count(k) for k in range(4)] == [15, 15, 15, 15]


def test_an_export_reads_its_delta_split(spark, store, tmp_path):
    setting = Setting(spark, str(tmp_path))
    setting.tables = store
    setting.register(control_row("t", "id", 2, 60))
    setting.run()
    sent = setting.sent()["t"]
    assert sorted(r["id"] for r in sent) == list(range(60, 100))
    assert {r["part"] for r in sent} == {0, 1, 2, 3}
    assert setting.state("t").longoffset == 99
    # One value is left: nothing to split.
    setting.run()
    assert [(r["id"], r["part"]) for r in setting.sent()["t"]] == [(99, 0)]


def test_bounds(spark):
    frame = spark.sql("SELECT 5L AS l, 5 AS i, TIMESTAMP '2024-01-02 00:00:00' AS t, TIMESTAMP_NTZ '2024-01-02 00:00:00' AS n")
    assert split_bounds(Check("t", frame, "l", 2, 3), 9) == ("3", "10")
    assert split_bounds(Check("t", frame, "i", 1, 3), 9) == ("3", "10")
    assert split_bounds(Check("t", frame, "l", 2, 9), 9) is None
    assert split_bounds(Check("t", frame, "l", 2, None), 9) is None
    assert split_bounds(Check("t", frame, "l", 2, 3), None) is None
    for column in "tn":
        bounds = split_bounds(Check("t", frame, column, 0, 1_704_067_200_000_000), 1_704_153_600_123_455)
        assert bounds == ("2024-01-01 00:00:00", "2024-01-02 00:00:00.123456")


def test_stride_counts(spark):
    check = Check("t", spark.range(100), "id", 2, 10)
    counts = {r.part: r.row_count for r in stride_counts(check, 99, 4).collect()}
    assert counts == {0: 23, 1: 23, 2: 23, 3: 21}
    with pytest.raises(ValueError):
        stride_counts(Check("t", spark.range(9), "id", 2, None), 5, 2)
