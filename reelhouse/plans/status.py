"""Outcome of each table of a run."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from reelhouse.sources import states

WRITTEN, SKIPPED, FAILED = "written", "skipped", "failed"
AT_ONCE = 4


@dataclass(frozen=True)
class TableStatus:
    pipeline: str
    table: str
    status: str
    path: str | None = None
    rows: int | None = None
    error: str | None = None
    checks: Mapping[str, int] | None = None


class RunFailed(RuntimeError):
    """Some tables of a run failed; the others are written."""

    def __init__(self, statuses: list[TableStatus]):
        self.statuses = statuses
        failed = [f"{s.pipeline}/{s.table}: {s.error}" for s in statuses if s.status == FAILED]
        super().__init__("; ".join(failed))


Job = Callable[[], "str | None"]


@dataclass
class Run:
    """Builds the tables of one pipeline; a failure is recorded, the others are built."""

    spark: SparkSession
    pipeline: str
    statuses: list[TableStatus] = field(default_factory=list)
    checks: dict[str, Mapping[str, int]] = field(default_factory=dict)

    def build(
        self,
        jobs: Mapping[str, Job],
        run_date: date | None = None,
        counted: Collection[str] | None = None,
    ) -> None:
        """Run jobs that do not depend on each other, a few at a time, so that the
        last tasks of one table do not leave the cluster idle.

        A job writes its table and returns the path, None when its input is missing.
        With ``run_date`` only that ingestion date's rows are counted, with ``counted``
        only those of the tables it names.
        """
        with ThreadPoolExecutor(AT_ONCE) as pool:
            done = [
                pool.submit(
                    inheritable_thread_target(self.spark)(self._attempt),
                    table, job, run_date, counted is None or table in counted,
                )
                for table, job in jobs.items()
            ]
            self.statuses += [attempt.result() for attempt in done]

    def _attempt(
        self, table: str, job: Job, run_date: date | None, counted: bool
    ) -> TableStatus:
        try:
            path = job()
            if path is None:
                return TableStatus(self.pipeline, table, SKIPPED)
            rows = self._rows(path, run_date) if counted else None
            return TableStatus(
                self.pipeline, table, WRITTEN, path=path, rows=rows, checks=self.checks.get(table)
            )
        except Exception as error:  # noqa: BLE001 - isolation of tables is the point
            return TableStatus(
                self.pipeline, table, FAILED, error=f"{type(error).__name__}: {error}"
            )

    def _rows(self, path: str, run_date: date | None) -> int:
        """Rows now in the table. A count without columns is answered from the
        Parquet footers, and unlike an accumulator it stays exact when tasks are
        run again after a lost executor. The schema is given because a table
        without rows may have no file to take one from."""
        dated = T.StructType([T.StructField("ingestion_date", T.DateType())])
        state = states.at(self.spark, path)
        if state is None:
            written = self.spark.read.schema(dated).parquet(path)
        else:
            root, table, _ = path.rsplit("/", 2)
            written = states.scan(self.spark, root, table, state, dated)
        if run_date is not None:
            written = written.where(F.col("ingestion_date") == F.lit(run_date))
        return written.count()

    def lineage_rows(self) -> list[tuple]:
        return [
            (s.table, s.status, s.rows, s.error, dict(s.checks) if s.checks else None)
            for s in self.statuses
        ]


class Seen:
    """Whether a write came across rows of some kind, learned from the write itself.

    It spares the second scan that would look for them. The count behind it may
    be too high when tasks are repeated, but it is zero only if there are none. A
    write whose plan turns out empty watches nothing; then rows may have been there.
    """

    def __init__(self) -> None:
        self._observation = Observation()

    def watch(self, df: DataFrame, condition: Column) -> DataFrame:
        return df.observe(self._observation, F.count_if(condition).alias("rows"))

    def any(self) -> bool:
        """To be asked after the action on the watched frame has ended."""
        try:
            return self._observation.get.get("rows", 1) > 0
        except (AssertionError, Py4JJavaError):  # no metric: the watched part was optimised away
            return True
