"""Incremental table export on Spark: move new rows of many tables, batch by batch."""

from ebbmark.plans.export import BatchFailed, TableResult, export_batch
from ebbmark.sources.claims import BatchClaimed, Claims
from ebbmark.sources.control_log import CONTROL_SCHEMA, LOG_SCHEMA, ControlTable
from ebbmark.sources.sinks import RecordSink, file_sink, kafka_sink
from ebbmark.sources.tables import Split, TableStore
from ebbmark.sources.zone_map import ZoneMap

__all__ = [
    "BatchClaimed",
    "BatchFailed",
    "CONTROL_SCHEMA",
    "Claims",
    "ControlTable",
    "LOG_SCHEMA",
    "RecordSink",
    "Split",
    "TableResult",
    "TableStore",
    "ZoneMap",
    "export_batch",
    "file_sink",
    "kafka_sink",
]
