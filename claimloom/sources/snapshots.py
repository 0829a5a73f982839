"""Versions of a set of tables, and the pointer that says which one readers see.

Every load writes a new folder below `versions/`; `CURRENT` names the one that is published. The pointer is a small file that is renamed
into place, so readers find the old version or the new one and never a mix, whatever fails in between.
"""

import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from claimloom.sources import files

POINTER = "CURRENT"
VERSIONS = "versions"
#: Marks a version whose tables were all written and counted.
COMPLETE = "COMPLETE"


def new_version() -> str:
    """Names sort by the time they were made."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def folder_of(root: str, version: str) -> str:
    return f"{root}/{VERSIONS}/{version}"


def published(spark: SparkSession, root: str) -> str | None:
    """Name of the version that readers see, None before the first."""
    return files.read_small(spark, f"{root}/{POINTER}")


def publish(spark: SparkSession, root: str, version: str) -> None:
    """From now on readers see this version; who resolved the pointer before goes on with the old one."""
    files.write_small(spark, f"{folder_of(root, version)}/{COMPLETE}", version)
    files.write_small(spark, f"{root}/{POINTER}", version)


def prune(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Deletes all versions but the published one and those before it, `keep` in all, and what failed loads left; names of the deleted.

    A version younger than the published one may be a load at work, so it stays until a later one is published.
    """
    now = published(spark, root)
    names = sorted(files.names_in(spark, f"{root}/{VERSIONS}"))
    complete = [name for name in names if now and name <= now and files.read_small(spark, f"{folder_of(root, name)}/{COMPLETE}") is not None]
    stay = {*complete[-keep:], *(name for name in names if not now or name >= now)}
    gone = [name for name in names if name not in stay]
    for name in gone:
        files.delete(spark, folder_of(root, name))
    return gone
