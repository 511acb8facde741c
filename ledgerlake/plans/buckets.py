"""Tables in key-hash buckets with a manifest: a merge rewrites only the buckets that its batch touches.

A table is a folder: `data/<write>/bucket=<k>/` holds the files of a write, `_manifest/v<n>.json` says which write each bucket stands in. A commit is the
creation of the next manifest, which fails if another writer was first; readers take the newest. Files that no kept manifest names can be removed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import merge, text_keys
from .stages import children, create_file, read_text, remove

BUCKETS = 32
BUCKET = "_bucket"


def bucket_of(key: list[str], buckets: int) -> Column:
    """The bucket of a row, by its key as text."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(buckets)).cast("int")


class BucketTable:
    """A keyed table below path. buckets holds for a new table; one that is there keeps its own number."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def versions(self) -> list[int]:
        return sorted(int(f[1:-5]) for f in children(self.spark, f"{self.path}/_manifest") if f.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict | None:
        """version, buckets (bucket -> write), count of buckets, schema and the tag of its commit; None before the first."""
        have = self.versions()
        if not have:
            return None
        return json.loads(read_text(self.spark, f"{self.path}/_manifest/v{have[-1] if version is None else version}.json"))

    def read(self, version: int | None = None, only: list[int] | None = None) -> DataFrame | None:
        """The rows of a version, or of some of its buckets; None without a version. Columns that older files lack are null."""
        kept = self.manifest(version)
        if kept is None:
            return None
        schema = T.StructType.fromJson(kept["schema"])
        folders = [f"{self.path}/data/{write}/{BUCKET}={b}" for b, write in kept["buckets"].items() if only is None or int(b) in only]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _commit(self, before: dict | None, rows: DataFrame, replaced: list[int], count: int, tag: str | None) -> dict:
        """Write rows, all of the replaced buckets, and the manifest that names them."""
        write = uuid.uuid4().hex
        rows.withColumn(BUCKET, bucket_of(self.key, count)).repartition(F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{write}")
        written = [int(f.split("=")[1]) for f in children(self.spark, f"{self.path}/data/{write}") if f.startswith(f"{BUCKET}=")]
        stay = {b: w for b, w in (before["buckets"] if before else {}).items() if int(b) not in replaced}
        new = {"version": before["version"] + 1 if before else 0, "count": count, "tag": tag, "schema": rows.schema.jsonValue(), "buckets": stay | {str(b): write for b in written}}
        create_file(self.spark, f"{self.path}/_manifest/v{new['version']}.json", json.dumps(new))
        return new

    def replace(self, rows: DataFrame, tag: str | None = None) -> dict:
        """A version of rows alone."""
        before = self.manifest()
        return self._commit(before and before | {"buckets": {}}, text_keys(rows, self.key), [], before["count"] if before else self.buckets, tag)

    def merge(self, batch: DataFrame, now: Column, preserve: tuple[str, ...] = (), tag: str | None = None, newer: list[str] | None = None) -> dict:
        """Merge a batch (each key once) and commit; returns the manifest.

        Only buckets that the batch touches are read and written. A commit whose tag is the newest version's is done already. newer: columns by which a
        row of the batch must not lie behind the stored one. Columns that are new are added; if a column's type changes, all buckets are rewritten."""
        before, batch = self.manifest(), text_keys(batch, self.key)
        if before is None:
            return self._commit(None, merge(self.spark.createDataFrame([], batch.schema), batch, self.key, now, preserve).drop("_action"), [], self.buckets, tag)
        if tag is not None and before["tag"] == tag:
            return before
        count, kinds = before["count"], {f["name"]: T.StructField.fromJson(f).dataType for f in before["schema"]["fields"]}
        retyped = [c for c in batch.columns if c in kinds and kinds[c] != batch.schema[c].dataType]
        touched = sorted(r[0] for r in batch.select(bucket_of(self.key, count)).distinct().collect())  # at most as many numbers as there are buckets
        if not touched and not retyped and set(batch.columns) <= set(kinds):
            return before
        if retyped:
            touched = list(range(count))
        stored = self.read(only=touched)
        for c in retyped:
            stored = stored.withColumn(c, F.col(c).cast(batch.schema[c].dataType))
        if newer:
            held = stored.select(*self.key, F.struct(*newer).alias("_held"))
            batch = batch.join(held, self.key, "left").where(F.col("_held").isNull() | (F.struct(*newer) >= F.col("_held"))).drop("_held")
        return self._commit(before, merge(stored, batch, self.key, now, preserve).drop("_action"), touched, count, tag)

    def retain(self, versions: int = 3) -> int:
        """Remove all but the newest versions and the writes that none of them names; returns how many folders went."""
        have = self.versions()
        kept = {w for v in have[-versions:] for w in self.manifest(v)["buckets"].values()}
        gone = [w for w in children(self.spark, f"{self.path}/data") if w not in kept]
        for v in have[:-versions]:
            remove(self.spark, f"{self.path}/_manifest/v{v}.json")
        for w in gone:
            remove(self.spark, f"{self.path}/data/{w}")
        return len(gone)
