"""Stored stages of a run, and the manifests that let a later run take up where an earlier one broke off."""

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from claimloom.sources import files

MANIFESTS = "_stages"
PRINTED_FIELDS = "spark.sql.debug.maxToStringFields"
#: Raised when a change of the code changes what stages hold, so that older ones are not taken up.
CODE = 2


def hashed(*parts) -> str:
    """Digest of plain values; dates and the like count by their text."""
    return hashlib.sha256(json.dumps(parts, default=str, sort_keys=True).encode()).hexdigest()


def source_fingerprint(df: DataFrame) -> str | None:
    """Digest of the plan of a frame and of the files that it reads; None when it reads anything else, as nothing tells such data apart.

    The code of Python functions in the plan is not seen.
    """
    spark, plan = df.sparkSession, df._jdf.queryExecution().analyzed()
    leaves, read = plan.collectLeaves(), sorted(df.inputFiles())
    names = {leaves.apply(i).nodeName() for i in range(leaves.size())}
    if not read or names - {"LogicalRelation", "Range", "OneRowRelation"} or not plan.subqueriesAll().isEmpty():
        return None
    before = spark.conf.get(PRINTED_FIELDS)
    spark.conf.set(PRINTED_FIELDS, str(2**31 - 1))
    try:
        text = plan.canonicalized().toString()
    finally:
        spark.conf.set(PRINTED_FIELDS, before)
    return hashed(text, df.schema.json(), files.fingerprint(spark, *read))


class StageStore:
    """Stages written as Parquet below `out`, each with a manifest once its files are complete.

    A manifest names the fingerprint of all that went into a stage: its arguments, the fingerprints of the stages it reads, and
    at the start that of the source. With `resume`, a stage whose fingerprint and files are as its
    manifest says is read back and not computed; whatever depends on something that changed is computed anew. A source
    without a fingerprint (None) is never taken up, and neither is what reads it.
    """

    def __init__(self, spark: SparkSession, out: str, resume: bool, source: str | None):
        self.spark, self.out, self.resume = spark, out, resume
        self.prints: dict[str, str | None] = {"source": source}
        self.reused: list[str] = []
        #: Aggregates of each stage, taken while it was written.
        self.counts: dict[str, dict] = {}
        if not resume:
            files.delete(spark, f"{out}/{MANIFESTS}")

    def _manifest(self, name: str) -> str:
        return f"{self.out}/{MANIFESTS}/{name.replace('/', '.')}.json"

    def keep(
        self,
        name: str,
        build: Callable[[], DataFrame],
        reads: tuple[str, ...],
        complete: Callable[[DataFrame], bool] = lambda _: True,
        measures: dict[str, str] | None = None,
        **arguments,
    ) -> DataFrame:
        """The stage `name`, built and stored unless a complete one can be taken up. `complete` judges what was stored earlier.

        `measures` are aggregates over the stage's rows (name to SQL), which `counts` has then; they are kept in the manifest.
        """
        path, inputs, measures = f"{self.out}/{name}", [self.prints[x] for x in reads], measures or {}
        self.prints[name] = made = hashed(CODE, name, arguments, inputs, measures) if all(inputs) else None
        if self.resume and made and (earlier := self._earlier(name, made, path)) is not None and complete(earlier):
            self.reused.append(name)
            return earlier
        files.delete(self.spark, self._manifest(name))
        df = build()
        self.counts[name] = files.write_counted(df, path, measures)
        if made:
            said = {"fingerprint": made, "files": files.fingerprint(self.spark, path), "schema": df.schema.jsonValue(), "counts": self.counts[name]}
            files.write_small(self.spark, self._manifest(name), json.dumps(said))
        return self.spark.read.schema(df.schema).parquet(path)

    def _earlier(self, name: str, made: str, path: str) -> DataFrame | None:
        text = files.read_small(self.spark, self._manifest(name))
        said = json.loads(text) if text else {}
        if said.get("fingerprint") != made or said["files"] != files.fingerprint(self.spark, path):
            return None
        self.counts[name] = said["counts"]
        return self.spark.read.schema(T.StructType.fromJson(said["schema"])).parquet(path)

    def remembered(self, name: str, value: str) -> str:
        """The value that the run which is taken up used, else this one, which is remembered."""
        path = f"{self.out}/{MANIFESTS}/{name}.txt"
        earlier = files.read_small(self.spark, path) if self.resume else None
        if earlier is None:
            files.write_small(self.spark, path, value)
        return earlier or value
