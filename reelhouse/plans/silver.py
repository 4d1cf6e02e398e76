"""Bronze to silver: flatten, check, deduplicate, quarantine."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, time
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import schemas, settings
from reelhouse.operators import flatten, quality
from reelhouse.plans.roots import Roots
from reelhouse.plans.status import Run, TableStatus
from reelhouse.sinks import lineage, tables
from reelhouse.sinks import snapshots as snapshots_out
from reelhouse.sinks import states as states_out
from reelhouse.sources import commits, layers, snapshots, states, storage


@dataclass(frozen=True)
class SilverSpec:
    table: str
    bronze: str
    flatten: Callable[..., DataFrame]
    rules: settings.QualityRules

    @property
    def quarantine(self) -> str:
        return self.table.replace("silver", "quarantine", 1)


TABLES = (
    SilverSpec("silver_video_stats", "bronze_video_stats", flatten.video_stats,
               settings.VIDEO_RULES),
    SilverSpec("silver_categories", "bronze_categories", flatten.categories,
               settings.CATEGORY_RULES),
    SilverSpec("silver_keyword_videos", "bronze_keyword_videos", flatten.search_videos,
               settings.SEARCH_RULES),
    SilverSpec("silver_trending", "bronze_trending", flatten.video_stats, settings.VIDEO_RULES),
    SilverSpec("silver_channel_stats", "bronze_channel_stats", flatten.channel_stats,
               settings.CHANNEL_RULES),
    SilverSpec("silver_trending_by_category", "bronze_trending_by_category",
               flatten.video_stats, settings.VIDEO_RULES),
    SilverSpec("silver_channel_videos", "bronze_channel_videos", flatten.search_videos,
               settings.SEARCH_RULES),
)


#: Bytes of bronze that make a bucket of silver, when a table is built from scratch.
BUCKET_BYTES = 128 << 20
LEAST_BUCKETS = 8
#: Rows of one key that may go to one task as they are. A key with more is first reduced
#: by every task that scans it, which takes a second shuffle.
HOT_ROWS = 100_000


@dataclass
class Pending:
    """Bronze files a state lacks, of batch and stream; what it holds with them, by
    partition; and whether something it holds was replaced since."""

    files: dict[str, list[str]]
    holds: dict[str, str]
    redo: bool = False


def pending(
    spark: SparkSession, roots: Roots, bronze: str, last: date, held: Mapping[str, str] | None
) -> Pending | None:
    """By the commit logs, up to the day ``last``; None when there is no such table.

    Partitions that no log entry speaks of are not passed over: they raise. A partition
    whose folder is gone keeps the rows it gave.
    """
    found, there = Pending({}, dict(held or {})), False
    for table in (bronze, layers.stream_table(bronze)):
        path = storage.join(roots.bronze, table)
        if not storage.exists(spark, path):
            continue
        there = True
        log = commits.read(spark, path)
        doubtful = [
            name
            for name in commits.unlogged(spark, path, log)
            if name.removeprefix("ingestion_date=") <= f"{last:%Y-%m-%d}"
        ]
        if doubtful:
            raise RuntimeError(
                f"{table} has partitions without a commit: {', '.join(doubtful)}; "
                "write them again, or take them as they are with sinks.commits.adopt"
            )
        present = set(commits.partitions(spark, path))
        for partition, entries in commits.current(log).items():
            entries = [c for c in entries if commits.day(c, partition) <= f"{last:%Y-%m-%d}"]
            if not entries or partition not in present:
                continue
            name, keys = f"{table}/{partition}", [c.key for c in entries]
            known = found.holds.get(name)
            if known is not None and known not in keys:
                found.redo = True
            new = entries[keys.index(known) + 1 :] if known in keys else entries
            files = dict.fromkeys(f"{partition}/{file}" for c in new for file in c.files[partition])
            found.files.setdefault(table, []).extend(files)
            found.holds[name] = keys[-1]
    return found if there else None


def _read(spark: SparkSession, roots: Roots, bronze: str, files: Mapping[str, list[str]]) -> DataFrame:
    """The rows of these bronze files."""
    schema = layers.schema_of(bronze)
    parts = [spark.createDataFrame([], schema)]
    for table, names in files.items():
        if names:
            path = storage.join(roots.bronze, table)
            found = spark.read.schema(schema).option("basePath", path)
            rows = found.parquet(*[storage.join(path, name) for name in names])
            parts.append(rows.select(schemas.columns(schema)))
    return reduce(DataFrame.unionByName, parts[1:] or parts)


def _bytes_of(spark: SparkSession, roots: Roots, bronze: str) -> int:
    return sum(
        storage.size(spark, storage.join(roots.bronze, table))
        for table in (bronze, layers.stream_table(bronze))
    )


def _buckets_for(size: int) -> int:
    return max(LEAST_BUCKETS, 1 << (max(1, size // BUCKET_BYTES) - 1).bit_length())


_ROUND = "_round"


def _judged(
    rows: DataFrame, rules: settings.QualityRules, buckets: int, path: str, rounds: int
) -> DataFrame:
    """The judged rows with the bucket of their key, as a table by round: bronze is scanned
    once, and counts, quarantine, touched buckets and silver itself come from this."""
    judged = quality.judge(rows, rules).withColumn(
        states.BUCKET, states.bucket_of(rules.key, buckets)
    ).withColumn(_ROUND, F.col(states.BUCKET) % rounds)
    judged.write.partitionBy(_ROUND).parquet(path, compression=storage.COMPRESSION)
    return rows.sparkSession.read.schema(judged.schema).parquet(path)


def refine(
    spark: SparkSession,
    roots: Roots,
    spec: SilverSpec,
    run_ts: datetime,
    from_scratch: bool = False,
    keep: int = snapshots_out.KEEP,
    checks: dict[str, Mapping[str, int]] | None = None,
    buckets: int | None = None,
) -> str | None:
    """Bring one table up to the day of the run.

    Silver lies in hash buckets of its key. The state of the last earlier day tells
    which bronze commits it holds. Only files of later ones are read, whatever their
    day and whether a batch or a stream wrote them; the buckets their keys fall in are
    read, compared and written again, all others stay where they are. Keeping the
    latest row per key of both gives the rows that all of bronze would give. When a
    partition it holds was replaced since, all of bronze is read, as with
    ``from_scratch`` and on a first run; then ``buckets`` (or the size of bronze) says
    how many buckets there are. ``checks`` receives the counts of the quality checks
    over the rows read. A large table is written in rounds of buckets.
    """
    today, last = datetime.combine(run_ts.date(), time.min), run_ts.date()
    since = None if from_scratch else snapshots.newest(spark, roots.silver, spec.table, today)
    before = None if since is None else states.load(spark, roots.silver, spec.table, since)
    new = pending(spark, roots, spec.bronze, last, before.notes["bronze"] if before else None)
    if new is not None and new.redo:
        before = None
        new = pending(spark, roots, spec.bronze, last, None)
    if new is None:
        return None
    size = _bytes_of(spark, roots, spec.bronze)
    key, n = spec.rules.key, before.buckets if before else buckets or _buckets_for(size)
    rows = spec.flatten(_read(spark, roots, spec.bronze, new.files), keep_unparsed=True)
    quiet = before is not None and not any(new.files.values())
    notes = {"buckets": n, "key": key, "bronze": new.holds}
    if quiet:
        written = states_out.write(spark, None, roots.silver, spec.table, run_ts, (), before.parts, notes)
        counts = dict.fromkeys(quality.counts_of(quality.judge(rows, spec.rules), spec.rules).columns, 0)
        tables.quarantine(
            quality.quarantined(quality.judge(rows, spec.rules)), roots.quarantine, spec.quarantine,
            last, any_rows=False,
        )
    else:
        scratch = storage.scratch(spark, "judged")
        try:
            rounds = tables.rounds_for(size)
            judged = _judged(rows, spec.rules, n, scratch, rounds)
            most = {"_most": F.coalesce(F.max("good"), F.lit(0))}
            counts = quality.counts_of(judged, spec.rules, most).first().asDict()
            hot = counts.pop("_most") > HOT_ROWS
            good = quality.passed(judged)
            carried: dict[str, list[str]] = {}
            touched = None
            if before is not None:
                # at most one number per bucket
                numbers = good.agg(F.collect_set(states.BUCKET)).first()[0]
                touched = {states.bucket_name(number) for number in numbers}
                carried = {part: places for part, places in before.parts.items() if part not in touched}

            def clean(r: int) -> DataFrame:
                found = good.where(F.col(_ROUND) == r).drop(_ROUND)
                if touched is not None:
                    again = {part for part in touched if int(part.split("=")[1]) % rounds == r}
                    old = states.scan(spark, roots.silver, spec.table, before, layers.schema_of(spec.table), again)
                    found = old.withColumn(states.BUCKET, states.bucket_of(key, n)).unionByName(found)
                if hot:
                    return quality.uniqueness(found, key)
                # one shuffle brings rows to their key and to their bucket
                found = states.in_buckets(found, key, n, states.parts_for(size, n))
                return quality.uniqueness(found, [states.BUCKET, states.PART, key]).drop(states.PART)

            parts = clean(0) if rounds == 1 else [clean(r) for r in range(rounds)]
            written = states_out.write(
                spark, parts, roots.silver, spec.table, run_ts, (states.BUCKET,), carried, notes, together=hot
            )
            tables.quarantine(
                quality.quarantined(judged).drop(states.BUCKET, _ROUND), roots.quarantine, spec.quarantine, last,
                any_rows=counts["input_rows"] > counts["valid_good"],
            )
        finally:
            storage.delete(spark, scratch)
    states_out.prune(spark, roots.silver, spec.table, run_ts, keep)
    if checks is not None:
        checks[spec.table] = counts
    return written


def build_silver(
    spark: SparkSession, roots: Roots, run_ts: datetime, from_scratch: bool = False
) -> list[TableStatus]:
    run = Run(spark, "silver")
    run.build(
        {
            spec.table: partial(
                refine, spark, roots, spec, run_ts, from_scratch, checks=run.checks
            )
            for spec in TABLES
        }
    )
    lineage.record(
        spark, roots.lineage, "silver", roots.bronze, roots.silver, run.lineage_rows(), run_ts
    )
    return run.statuses
