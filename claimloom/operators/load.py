"""Loading the star schema: a Parquet copy that is always kept, and an optional primary warehouse."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimloom.plans.sizing import shuffles_dropped
from claimloom.schema import LOAD_ORDER, LOAD_REPORT, STAR
from claimloom.sources import snapshots

# Writes one table, replacing what is there.
Sink = Callable[[DataFrame, str], None]
# Counts the rows of one table where a sink put it.
Rows = Callable[[str], int]


def parquet_sink(root: str, fact_codec: str | None = None) -> Sink:
    """`fact_codec` is that of the fact's files, whose digests take half the room with zstd; Spark plans joins by the sizes of files, so
    a fact then looks half as large as it is. All else has the session's codec."""

    def write(table: DataFrame, name: str) -> None:
        codec = {"compression": fact_codec} if fact_codec and name == "fact_claims" else {}
        with shuffles_dropped(table.sparkSession):
            table.write.options(**codec).mode("overwrite").parquet(f"{root}/{name}")

    return write


def jdbc_sink(options: dict[str, str]) -> Sink:
    """Drop and recreate the table over JDBC; `numPartitions` in the options bounds the open connections."""

    def write(table: DataFrame, name: str) -> None:
        table.write.format("jdbc").options(**options).option("dbtable", name).mode("overwrite").save()

    return write


def parquet_rows(spark: SparkSession, root: str) -> Rows:
    return lambda name: spark.read.schema(STAR[name]).parquet(f"{root}/{name}").count()


def jdbc_rows(spark: SparkSession, options: dict[str, str]) -> Rows:
    """Counted in the database, through a query of one row."""

    def rows(name: str) -> int:
        query = f"SELECT count(*) AS n FROM {name}"
        return int(spark.read.format("jdbc").options(**options).option("query", query).load().first()[0])

    return rows


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the version published under `root`, with declared schemas. The pointer is resolved once, so all
    tables are of one load, and stay so when another is published meanwhile. Without a pointer, as below a
    `parquet_sink`, they are read from `root` itself."""
    return _tables(spark, table_folders(spark, root))


def table_folders(spark: SparkSession, root: str) -> dict[str, str]:
    """Where the tables of the published version lie, or of `root` itself where none is published."""
    version = snapshots.published(spark, root)
    folder = root if version is None else snapshots.folder_of(root, version)
    return {name: f"{folder}/{name}" for name in LOAD_ORDER}


def _tables(spark: SparkSession, folders: dict[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.schema(STAR[name]).parquet(folder) for name, folder in folders.items()}


def register_views(star: dict[str, DataFrame]) -> None:
    """Make the tables available to `spark.sql` under their own names."""
    for name, table in star.items():
        table.createOrReplaceTempView(name)


def load_star(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    primary: Sink | None = None,
    primary_rows: Rows | None = None,
    keep_versions: int = 2,
    fact_codec: str | None = None,
) -> DataFrame:
    """Store the tables as a new version under `root`, publish it, copy them to `primary`, and return one status row per table and sink.

    The version is published when all its tables are written and counted, by a pointer renamed into place: readers of `root` see
    the old tables until then, all of them, also when the load fails half-way. The `keep_versions` newest published versions
    stay for readers that began earlier; older ones and remains of failed loads go.
    The Parquet copy comes first and feeds the primary sink, so no table is computed twice. It must succeed; a
    failure of the primary sink is reported instead of raised, and stops that sink so that the fact never lands
    without its dimensions. Dimensions are loaded before the fact. `primary_rows` counts in the primary sink; a count
    other than that of the copy is a failure, and without it the rows are unknown (NULL). `fact_codec` is as for `parquet_sink`.
    """
    version = snapshots.new_version()
    folder = snapshots.folder_of(root, version)
    keep = parquet_sink(folder, fact_codec)
    for name in LOAD_ORDER:
        keep(tables[name], name)
    stored = _tables(spark, {name: f"{folder}/{name}" for name in LOAD_ORDER})
    rows = {name: stored[name].count() for name in LOAD_ORDER}
    snapshots.publish(spark, root, version)
    snapshots.prune(spark, root, max(1, keep_versions))
    status = [(name, "backup", rows[name], True, None) for name in LOAD_ORDER]

    error = None
    for name in LOAD_ORDER if primary else ():
        found = 0
        if error is None:
            try:
                primary(stored[name], name)
                found = primary_rows(name) if primary_rows else None
                if found not in (None, rows[name]):
                    error = f"{name}: {found} of {rows[name]} rows arrived"
            except Exception as failure:  # noqa: BLE001 - any sink failure is a status, not a crash
                error = f"{name}: {failure}"
        status.append((name, "primary", found, error is None, error))
    return spark.createDataFrame(status, LOAD_REPORT)
