"""Named relations for SQL, and SQL files run over them."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelhouse import schemas
from reelhouse.sources import layers, states, storage

# The second names the dashboard's SQL uses.
ALIASES = {
    "fact_video_performance": "fact",
    "dim_category": "dim_cat",
    "gold_video_engagement": "gold_video",
    "gold_category_performance": "gold_cat",
    "gold_channel_performance": "gold_chan",
}


def register_views(
    spark: SparkSession, warehouse_root: str, gold_root: str | None = None, aliases: bool = False
) -> list[str]:
    """Register the tables that exist as temporary views; returns their names."""
    found = {t: layers.read_table(spark, warehouse_root, t) for t in schemas.WAREHOUSE}
    if gold_root is not None:
        found |= {t: layers.read_table(spark, gold_root, t) for t in schemas.GOLD}
    names = []
    for table, df in found.items():
        if df is None:
            continue
        for name in [table] + ([ALIASES[table]] if aliases and table in ALIASES else []):
            df.createOrReplaceTempView(name)
            names.append(name)
    return names


def _ddl(field: T.StructField) -> str:
    return f"`{field.name}` {field.dataType.simpleString()}"


def create_external_tables(
    spark: SparkSession, warehouse_root: str, database: str = "default"
) -> list[str]:
    """(Re)create catalog tables over the warehouse folders; the data stays put.

    ``warehouse_root`` has to be absolute. The fact is declared partitioned by
    year and month and its partitions are recovered; a table of shared parts gets a
    partition per part, wherever a run left it. Tables point at their newest complete
    snapshot, so call this again after each run.
    """
    created = []
    for table, schema in schemas.WAREHOUSE.items():
        name = f"`{database}`.`{table}`"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        location = layers.location(spark, warehouse_root, table)
        if location is None:
            continue
        state = states.at(spark, location)
        if state is not None:
            _over_parts(spark, name, schema, storage.join(warehouse_root, table), state)
            created.append(table)
            continue
        partitioned = table == "fact_video_performance"
        spark.sql(
            f"CREATE TABLE {name} ({', '.join(_ddl(f) for f in schema.fields)}) USING PARQUET "
            + ("PARTITIONED BY (year, month) " if partitioned else "")
            + f"LOCATION '{location}'"
        )
        if partitioned:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        created.append(table)
    return created


def _over_parts(
    spark: SparkSession, name: str, schema: T.StructType, path: str, state: states.State
) -> None:
    columns = [pair.split("=")[0] for pair in next(iter(state.parts), "").split("/") if pair]
    by = f"PARTITIONED BY ({', '.join(columns)}) " if columns else ""
    spark.sql(
        f"CREATE TABLE {name} ({', '.join(_ddl(f) for f in schema.fields)}) USING PARQUET {by}"
        f"LOCATION '{path}'"
    )
    for part, folders in state.parts.items():
        if len(folders) > 1:
            raise ValueError(f"{name}: part {part} lies in several folders")
        values = ", ".join("{}='{}'".format(*pair.split("=", 1)) for pair in part.split("/"))
        spark.sql(f"ALTER TABLE {name} ADD PARTITION ({values}) LOCATION '{path}/{folders[0]}'")


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """The query in ``text``, comments and all; lazy like any other."""
    return spark.sql(text)


def run_sql_file(spark: SparkSession, path: str) -> DataFrame:
    """The query in a file, wherever Spark can read it."""
    return run_sql(spark, storage.read_text(spark, path) or "")


def run_sql_folder(
    spark: SparkSession, folder: str
) -> tuple[dict[str, DataFrame], dict[str, PySparkException]]:
    """All ``*.sql`` files in name order: (results, errors), by file name.

    A file that cannot be analysed does not keep the others from running; errors of
    the data come up where a result is used, as ``plans.run.write_reports`` does.
    """
    results, errors = {}, {}
    for path in storage.files(spark, folder, ".sql"):
        name = path.rsplit("/", 1)[-1].removesuffix(".sql")
        try:
            results[name] = run_sql_file(spark, path)
        except PySparkException as error:
            errors[name] = error
    return results, errors
