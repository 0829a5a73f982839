"""Claims in CSV and Parquet files, and the shared folder that holds intermediate files."""

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions.columns import date_of
from claimloom.plans.sizing import bytes_of, shuffles_dropped, small_tasks
from claimloom.schema import RAW_CLAIMS
from claimloom.sources import csv_records

# Same dialect both ways: quotes are doubled, surrounding spaces are data, an empty field is NULL, and `""` is the empty text.
CSV_DIALECT = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
CORRUPT = "corrupt_record"
# Digests in hex are most of a fact, and take half the room with it: the default codec finds nothing in them.
PARQUET = {"compression": "zstd"}
# Records of a written CSV file, so that the file is smaller than a split for all but very long ones and can be read as it is.
CSV_FILE_RECORDS = 500_000
# Stands for empty fields inside the reader, where the default would take quoted empty texts for NULL too.
NO_TEXT = "\x00NULL"


_WRITTEN = T.StructType([T.StructField(name, T.StringType()) for name in [*RAW_CLAIMS.names, CORRUPT]])


def _records(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """All fields as text, and the whole record where it has too few or too many fields."""
    options = {**CSV_DIALECT, "mode": "PERMISSIVE", "multiLine": multi_line, "columnNameOfCorruptRecord": CORRUPT, "nullValue": NO_TEXT}
    if multi_line and _largest_file(spark, path) > bytes_of(spark.conf.get("spark.sql.files.maxPartitionBytes")):
        # The CSV reader takes a file whole when it may hold line breaks, so larger files are cut into records first.
        lines = _kept(csv_records.read_lines(spark, path))
        found = csv_records.records(lines, _kept(csv_records.split_states(lines)))
        fields = ", ".join(f"{name} STRING" for name in _WRITTEN.names)
        parsed = F.from_csv("record", fields, {name: str(value) for name, value in options.items() if name != "header"})
        return found.select(parsed.alias("fields")).select("fields.*")
    # All columns are parsed whatever is selected, as fields can only be counted then.
    return spark.read.schema(_WRITTEN).options(**options, columnPruning=False).csv(path)


def _kept(df: DataFrame) -> DataFrame:
    """Stored in the shared folder and read back."""
    path = shared_dir(df.sparkSession)
    df.write.options(**PARQUET).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _largest_file(spark: SparkSession, text: str) -> int:
    return max((status.getLen() for status in _walk(spark, text)), default=0)


def _is_corrupt(null: str) -> str:
    """Condition on the record; the second half is always true, as Spark refuses queries on that column alone."""
    return f"{CORRUPT} IS {null} AND length(concat_ws('', claim_id)) >= 0"


def _typed(field: T.StructField) -> Column:
    value = F.col(field.name)
    if field.dataType == T.IntegerType():
        number = value.try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int")).alias(field.name)
    return value.try_cast(field.dataType).alias(field.name)


class CsvClaims(NamedTuple):
    """Claims, and the text of the records with too few or too many fields."""

    claims: DataFrame
    corrupt: DataFrame


def csv_claims(spark: SparkSession, path: str, multi_line: bool = True) -> CsvClaims:
    """Claims and corrupt records of one parse, which is stored in the shared folder."""
    return _parted(_kept(_records(spark, path, multi_line)))


def _parted(parsed: DataFrame) -> CsvClaims:
    return CsvClaims(parsed.where(_is_corrupt("NULL")).select(*[_typed(f) for f in RAW_CLAIMS]), parsed.where(_is_corrupt("NOT NULL")).select(CORRUPT))


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Raw claims from the records with the right number of fields; `csv_claims` has the others too.

    A malformed number becomes NULL and is caught by the checks. Whole numbers may be written with decimals (`30.0`),
    as exports of columns with gaps do; a fraction of a day is malformed. `multi_line` accepts line breaks inside quotes: where
    a file is larger than a split (`spark.sql.files.maxPartitionBytes`), its lines are stored once and records put together
    from all splits side by side (`csv_records`). Without it records with line breaks are corrupt.
    """
    return _parted(_records(spark, path, multi_line)).claims


def corrupt_records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Text of the records that `read_csv` leaves out."""
    return _parted(_records(spark, path, multi_line)).corrupt


def write_csv(claims: DataFrame, path: str, multi_line: bool = True) -> None:
    """Writes what `read_csv` reads back with the same `multi_line`; without it, a text with a line break is an error."""
    if not multi_line:
        texts = [f.name for f in claims.schema if f.dataType == T.StringType()]
        broken = {name: F.raise_error(F.lit(f"line break in {name}")).cast("string") for name in texts}
        claims = claims.withColumns({n: F.when(F.col(n).rlike("[\\r\\n]"), e).otherwise(F.col(n)) for n, e in broken.items()})
    claims.write.options(**CSV_DIALECT, maxRecordsPerFile=CSV_FILE_RECORDS).mode("overwrite").csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType = RAW_CLAIMS) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_parquet(claims: DataFrame, path: str) -> None:
    with small_tasks(claims.sparkSession), shuffles_dropped(claims.sparkSession):
        claims.write.options(**PARQUET).mode("overwrite").parquet(path)


def write_counted(df: DataFrame, path: str, measures: dict[str, str]) -> dict:
    """Stores a frame and returns aggregates over its rows (name to SQL), taken by the tasks that write them.

    The aggregates sit above the last shuffle, in the stage that writes, of which Spark counts each partition's first successful task
    and no other: a task that fails, is computed again or runs twice changes no number.
    """
    if not measures:
        write_parquet(df, path)
        return {}
    seen = Observation(f"stored-{uuid.uuid4().hex}")
    write_parquet(df.observe(seen, *[F.expr(sql).alias(name) for name, sql in measures.items()]), path)
    return seen.get


def write_by_day(claims: DataFrame, root: str, batch: str = "all", emptied: tuple[str, ...] = ()) -> None:
    """Stores a batch of claims by service date; other days and batches stay as they are.

    One folder `day=<date>` per parsed service date. A day that occurs in the batch is replaced whole, so writing a batch again changes
    nothing, and a batch must bring all claims of its days. A day listed in `emptied` (yyyy-MM-dd) that has no claims in the batch
    loses those it had. Claims without a date, or with a text that is none, go to `day=undated-<batch>`, and are
    replaced by batch, as days cannot tell them apart. Batch names are letters, digits, `-`, `_` and `.`.

    The rebalance keeps a day together when it is small, so that days do not scatter over tiny files; adaptive execution
    splits a large one over several tasks.
    """
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
        raise ValueError(f"not a name of a batch: {batch!r}")
    undated = f"undated-{batch}"
    spark = claims.sparkSession
    watched = [f"{root}/day={day}" for day in (*(date.fromisoformat(day).isoformat() for day in emptied), undated)]
    before = {folder: names_in(spark, folder) for folder in watched}
    # The day is a function of the text, so it is computed above the shuffle.
    dated = claims.hint("rebalance", F.col("service_date")).withColumn("day", F.coalesce(F.expr(date_of("service_date")).cast("string"), F.lit(undated)))
    writer = dated.write.options(**PARQUET).partitionBy("day").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(root)
    for folder, names in before.items():
        # Every write names its files anew: what is still there was not replaced, so the batch has no such claims.
        if names and names_in(spark, folder) == names:
            delete(spark, folder)


def read_day(spark: SparkSession, root: str, day: str) -> DataFrame:
    """Claims of one service date (yyyy-MM-dd); only that folder is listed and read."""
    folder = f"{root}/day={day}"
    if not names_in(spark, folder):
        return spark.createDataFrame([], RAW_CLAIMS)
    return spark.read.schema(RAW_CLAIMS).option("basePath", root).parquet(folder).select(*RAW_CLAIMS.names)


def read_days(spark: SparkSession, root: str) -> DataFrame:
    """Claims of all days, and those without a date."""
    if not names_in(spark, root):
        return spark.createDataFrame([], RAW_CLAIMS)
    return spark.read.schema(RAW_CLAIMS).parquet(root).select(*RAW_CLAIMS.names)


def days_stored(spark: SparkSession, root: str) -> list[str]:
    """Dates (yyyy-MM-dd) that have a folder."""
    return [name.removeprefix("day=") for name in names_in(spark, root) if name.startswith("day=") and not name.startswith("day=undated-")]


def _path(spark: SparkSession, text: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def has_data(spark: SparkSession, text: str) -> bool:
    """True when the path exists and is not the remainder of a write that never finished."""
    jvm = spark.sparkContext._jvm
    path, fs = _path(spark, text)
    if not fs.exists(path):
        return False
    if fs.getFileStatus(path).isFile():
        return True
    child = jvm.org.apache.hadoop.fs.Path
    return fs.exists(child(path, "_SUCCESS")) or not fs.exists(child(path, "_temporary"))


def size_of(spark: SparkSession, text: str) -> int:
    """Bytes below a path."""
    path, fs = _path(spark, text)
    return fs.getContentSummary(path).getLength()


def names_in(spark: SparkSession, text: str) -> list[str]:
    """Names in a folder, hidden ones left out; none where there is no folder."""
    path, fs = _path(spark, text)
    if not fs.exists(path):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(path))
    return sorted(name for name in names if name[0] not in "._")


def delete(spark: SparkSession, text: str) -> None:
    path, fs = _path(spark, text)
    fs.delete(path, True)


def write_small(spark: SparkSession, text: str, content: str) -> None:
    """Writes a small file beside its place and renames it: readers see the old content or the new."""
    jvm = spark.sparkContext._jvm
    path, fs = _path(spark, text)
    path = fs.makeQualified(path)
    draft = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(content.encode()))
    out.close()
    renames = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(renames, 1)
    options[0] = renames.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, path, options)


def read_small(spark: SparkSession, text: str) -> str | None:
    """Content of a small file, None where there is none."""
    path, fs = _path(spark, text)
    if not fs.exists(path):
        return None
    source = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def _walk(spark: SparkSession, text: str) -> Iterator:
    """Status of every file below a path."""
    path, fs = _path(spark, text)
    if fs.exists(path):
        walk = fs.listFiles(path, True)
        while walk.hasNext():
            yield walk.next()


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Changes when a file below the paths is added, removed or written anew: hash of names, lengths and times."""
    found = [f"{status.getPath()} {status.getLen()} {status.getModificationTime()}" for text in paths for status in _walk(spark, text)]
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Claims from the CSV at `path`; when there is none, build them, store them there and read them back.

    Reading back gives the first run and every later one the same rows and types.
    """
    if not has_data(spark, path):
        write_csv(build(), path)
    return read_csv(spark, path)


def shared_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` or, where that is unset, the warehouse. The default warehouse is a folder of one machine, so on a
    cluster a fallback to local files is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    root = spark.conf.get("spark.sql.warehouse.dir")
    path, fs = _path(spark, root)
    if fs.makeQualified(path).toUri().getScheme() == "file" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share: the warehouse is on the local disk")
    return root.rstrip("/")


def shared_dir(spark: SparkSession) -> str:
    """A new folder that every executor can reach. Whoever set the shared folder removes what is in it; nothing here is read
    by a later call."""
    return f"{shared_root(spark)}/claimloom/{uuid.uuid4().hex}"
