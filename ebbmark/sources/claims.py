"""Claims that keep two runs of one batch apart."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbmark.sources.tables import TableStore

CHOOSING, NUMBERED, RELEASED = range(3)


class BatchClaimed(RuntimeError):
    """Another run holds the batch, or took it over after this run's lease ended."""


def _millis() -> int:
    return time.time_ns() // 1_000_000


@dataclass(frozen=True)
class Claims:
    """A table of claims in a store that can only append and read.

    Every run takes a number (the ticket of a bakery): it says that it is
    choosing, reads the largest number there is, says its own, one higher, and
    then looks who else is there. Whoever is still choosing is waited for; the
    lowest number holds the batch, the run id breaks ties. The others release
    their claims and stop. So two runs that overlap in any way never both go on,
    without a store that locks or compares.

    A run that died without a release holds its batch until ``lease_seconds``
    after its claim. A run must be done by then: ``Claim.confirm`` fails past it.
    ``folders`` gives every claim a folder of its own, for file stores, whose
    appends to one folder disturb each other.
    """

    store: TableStore
    name: str = "export_claims"
    lease_seconds: float = 6 * 3600
    folders: bool = True
    poll_seconds: float = 1.0
    clock: Callable[[], int] = field(default=_millis, compare=False)

    def say(self, spark: SparkSession, batch: int, run: str, step: int, number: int, since: int) -> None:
        row = spark.createDataFrame([(number, since)], "number bigint, since_millis bigint").coalesce(1)
        if self.folders:
            self.store.append(row, f"{self.name}/batch={batch}/run={run}/step={step}")
        else:
            said = row.select(F.lit(batch).alias("batch"), F.lit(run).alias("run"), F.lit(step).alias("step"), "*")
            self.store.append(said, self.name)

    def standing(self, spark: SparkSession, batch: int) -> DataFrame:
        """The latest step of every claim on a batch that is neither released nor past its lease."""
        said = self.store.read(spark, self.name).filter(F.col("batch") == batch)
        last = said.groupBy(F.col("run").cast("string").alias("run")).agg(
            F.max("step").cast("int").alias("step"),
            F.max("number").alias("number"),
            F.min("since_millis").alias("since_millis"),
        )
        return last.filter((F.col("step") != RELEASED) & (F.col("since_millis") > self.clock() - int(self.lease_seconds * 1000)))

    @contextmanager
    def hold(self, spark: SparkSession, batch: int, run: str | None = None) -> Iterator[Claim]:
        """Hold a batch for a ``with`` block, or raise :class:`BatchClaimed`."""
        run = run or f"run-{uuid.uuid4().hex}"
        since = self.clock()
        claim = Claim(self, spark, batch, run, since)
        self.say(spark, batch, run, CHOOSING, 0, since)
        try:
            highest = self.standing(spark, batch).agg(F.max("number")).first()[0] or 0
            self.say(spark, batch, run, NUMBERED, highest + 1, since)
            while claim.others(F.col("step") == CHOOSING):
                time.sleep(self.poll_seconds)
            before = (F.col("number") < highest + 1) | ((F.col("number") == highest + 1) & (F.col("run") < run))
            first = claim.others((F.col("step") == NUMBERED) & before)
            if first:
                raise BatchClaimed(f"batch {batch} is held by {first[0]}")
            yield claim
        finally:
            self.say(spark, batch, run, RELEASED, 0, since)


@dataclass(frozen=True)
class Claim:
    """A batch that is held."""

    claims: Claims
    spark: SparkSession
    batch: int
    run: str
    since_millis: int

    def others(self, which) -> list[str]:
        standing = self.claims.standing(self.spark, self.batch).filter(which & (F.col("run") != self.run))
        return sorted(row.run for row in standing.select("run").collect())

    def confirm(self) -> None:
        """Fail once the lease has ended, as another run may hold the batch by then."""
        if self.claims.clock() - self.since_millis >= self.claims.lease_seconds * 1000:
            raise BatchClaimed(f"the lease of {self.run} on batch {self.batch} has ended")
