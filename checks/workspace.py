"""A lakehouse built from the test tables by the library's own jobs.

Built once per session and table folder, in the shared folder the cluster names
(``spark.checkpoint.dir``): response pages, landed items, bronze, silver, gold,
warehouse. Report queries read its warehouse, as reports do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from reelhouse import schemas
from reelhouse.plans.landing import Pages, land
from reelhouse.plans.reports import Star
from reelhouse.plans.roots import Roots
from reelhouse.plans.run import run_all
from reelhouse.plans.status import FAILED, RunFailed
from reelhouse.sinks import landing
from reelhouse.sources import shards, storage

_KINDS = {
    "channel_videos": "search",
    "keyword_videos": "search",
    "channel_stats": "channel",
    "categories": "category",
}
_built: dict[tuple[str, str], Roots] = {}
_stars: dict[tuple[str, str], Star] = {}


def _number(item_id: str) -> Column:
    return F.col(item_id).cast("bigint")


def write_pages(spark: SparkSession, sf_dir: str, base: str) -> Pages:
    """Response pages of one run over all orders, customers and nations."""
    path = storage.join(base, "videos")
    inputs.videos(spark, sf_dir).write.parquet(path, compression=storage.COMPRESSION)
    flat = spark.read.parquet(path)
    # Trending lists carry the finished orders with a view more, and the lists
    # per category with two more; the first one a video is seen in counts.
    finished = flat.where("description = 'status F'")
    again = shards.label_shards(finished, "category_id").withColumn(
        "views", F.col("views") + F.when(F.col("_source_category") == "0", 1).otherwise(2)
    )
    overall = inputs.video_items(again.where("_source_category = '0'"))
    per_category = inputs.video_items(again.where("_source_category <> '0'"))
    search = inputs.search_items(flat)
    to_pages = inputs.to_pages
    pages = {
        "video_stats": to_pages(inputs.video_items(flat), _number("id")),
        "trending": to_pages(overall, _number("id"), _source_category=F.lit("0")),
        "trending_by_category": to_pages(
            per_category, _number("id"), _source_category=F.col("snippet.categoryId")
        ),
        "channel_videos": to_pages(search, _number("id.videoId")),
        "keyword_videos": inputs.keyword_pages(spark, sf_dir, flat),
        "channel_stats": to_pages(inputs.channel_items(spark, sf_dir), _number("id")),
        "categories": to_pages(inputs.category_items(spark, sf_dir), _number("id")),
    }

    def keep(name: str) -> DataFrame:
        path = storage.join(base, "pages", name)
        landing.write_lines(pages[name], path)
        return spark.read.schema(schemas.response_page(_KINDS.get(name, "video"))).json(path)

    # one after the other, the largest first: each shuffles all it writes
    kept = Pages(**{name: keep(name) for name in pages})
    storage.delete(spark, path)
    return kept


def prepare(spark: SparkSession, sf_dir: str) -> tuple[Roots, Pages]:
    """An empty lakehouse and the response pages of its first run."""
    base = storage.scratch(spark, "lakehouse")
    with storage.shuffles_dropped(spark):
        return Roots.under(base), write_pages(spark, sf_dir, base)


def build(spark: SparkSession, sf_dir: str, prepared: tuple[Roots, Pages] | None = None) -> Roots:
    """Build a fresh lakehouse, whether or not there is one. The pages are deleted once
    their items are landed, and those once in bronze, but for the statistics, which a
    stream reads too."""
    roots, pages = prepared or prepare(spark, sf_dir)
    folder = storage.join(roots.raw.rsplit("/", 1)[0], "pages")

    def drop(name: str) -> None:
        storage.delete(spark, storage.join(folder, name))

    with storage.shuffles_dropped(spark):
        landed = land(
            spark, roots, pages, inputs.RUN_TS, default_mark=inputs.START_MARK, done=drop
        )
    if any(status.status == FAILED for status in landed):
        raise RunFailed(landed)
    storage.delete(spark, folder)
    run_all(
        spark, roots, inputs.RUN_TS, as_of=inputs.AS_OF, keep_landed=["raw_video_stats"]
    )
    return roots


def use(spark: SparkSession, sf_dir: str, roots: Roots) -> None:
    """Let queries of this session read a lakehouse that is built already."""
    _built[spark.sparkContext.applicationId, sf_dir] = roots


def roots_for(spark: SparkSession, sf_dir: str) -> Roots:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = build(spark, sf_dir)
    return _built[key]


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The warehouse, its files listed once and not again for each report."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stars:
        _stars[key] = Star.from_warehouse(spark, roots_for(spark, sf_dir).warehouse)
    return _stars[key]
