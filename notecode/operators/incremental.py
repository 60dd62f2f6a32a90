"""Incremental processing with the target table as the only state.

Every target row carries the key and version of the source rows it was made from
(``source_key``, ``source_version``), or lists the keys and carries the time it was made.
What is left to do is then an anti-join of the sources against the published target:
there is no separate cursor that could run ahead of, or behind, the data.

Defined results:

* repeated source rows count once, with their latest version;
* a null key is no record; a record whose versions are all null is always pending,
  as nothing shows that its present state was processed;
* an empty target leaves every record pending, an empty source none;
* rows of failed runs, or outside every run, do not count as processed.
"""

from __future__ import annotations

import os
import time
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_versions(sources: list[DataFrame], key: str, version: str) -> DataFrame:
    """One row per key over all sources, with its latest version."""
    parts = [s.select(F.col(key).alias("source_key"), F.col(version).alias("source_version")) for s in sources]
    rows = reduce(DataFrame.unionByName, parts).where(F.col("source_key").isNotNull())
    return rows.groupBy("source_key").agg(F.max("source_version").alias("source_version"))


def processed_versions(target: DataFrame, ledger: DataFrame, keys: str, made_at: str) -> DataFrame:
    """The latest time at which a successful run wrote each source key.

    Runs are matched by calendar day first, so the time-range test is an equi-join
    however long the ledger gets.
    """
    day = F.explode(F.sequence(F.to_date("started_at"), F.to_date("finished_at")))
    runs = (
        ledger.where((F.col("status") == "SUCCEEDED") & (F.col("started_at") <= F.col("finished_at")))
        .select(F.col("started_at").alias("_from"), F.col("finished_at").alias("_to"), day.alias("_day"))
        .distinct()
    )
    rows = target.select(F.col(keys).alias("_keys"), F.col(made_at).alias("_made"), F.to_date(made_at).alias("_day"))
    good = rows.join(runs, "_day").where(F.col("_made").between(F.col("_from"), F.col("_to")))
    return (
        good.select(F.explode("_keys").alias("source_key"), "_made")
        .where(F.col("source_key").isNotNull())
        .groupBy("source_key")
        .agg(F.max("_made").alias("processed_at"))
    )


def pending(sources: list[DataFrame], target: DataFrame, ledger: DataFrame, *, key: str = "entity_id", version: str = "extracted_at", keys: str = "source_entity_ids", made_at: str = "merged_at") -> DataFrame:
    """Source records no successful run has processed in their present version: (source_key, source_version)."""
    source, done = latest_versions(sources, key, version), processed_versions(target, ledger, keys, made_at)
    held = (F.col("s.source_key") == F.col("d.source_key")) & (F.col("d.processed_at") >= F.col("s.source_version"))
    return source.alias("s").join(done.alias("d"), held, "left_anti")


class VersionedTarget:
    """A target table published version by version.

    Every run writes its rows to a folder of its own. A version is a small file that lists the
    folders in order; it is put into place whole, and only if no file of that number is
    there. So readers see the old version or the new one, never a part; a run that dies
    earlier leaves the target as it was; of two runs that publish at once one fails, with
    nothing of the other's touched, and can be repeated. Folders are deleted by ``vacuum``
    only, when no kept version names them and they are older than any run takes.

    A key's rows are those of the last folder that has the key: a run writes as much as it
    changed. ``compact`` writes the folders into one when reading them grows dear.
    ``source_key`` must not be null.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._hadoop)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _list(self, name: str) -> list:
        return list(self._fs.listStatus(self._at(name))) if self._fs.exists(self._at(name)) else []

    def current(self) -> int:
        """The published version, 0 before the first."""
        return max([int(f.getPath().getName()) for f in self._list("versions") if f.getPath().getName().isdigit()], default=0)

    def folders(self, version: int | None = None) -> list[str]:
        """The folders of a version, oldest first."""
        version = self.current() if version is None else version
        return self.spark.read.text(f"{self.path}/versions/{version:08d}").head()[0].split(" ") if version else []

    def read(self, schema=None) -> DataFrame:
        folders = self.folders()
        if not folders:
            if schema is None:
                raise ValueError("nothing is published yet and no schema was given")
            return self.spark.createDataFrame([], schema)
        parts = [self.spark.read.parquet(f"{self.path}/data/{f}").withColumn("_part", F.lit(k)) for k, f in enumerate(folders)]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        if len(parts) > 1:
            rows = rows.join(rows.groupBy("source_key").agg(F.max("_part").alias("_part")), ["source_key", "_part"])
        return rows.drop("_part")

    def pending(self, source: DataFrame, key: str, version: str) -> DataFrame:
        """Rows of ``source`` whose (key, version) the published target does not hold, one per key."""
        return self.pending_rows(source, key, version).dropDuplicates([key])

    def pending_rows(self, source: DataFrame, key: str, version: str) -> DataFrame:
        """All rows of the newest version of the keys that the published target does not hold in that version."""
        newest = source.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.max(version).alias("_v"))
        if self.current():
            done = self.read().select(F.col("source_key").alias("_dk"), F.col("source_version").alias("_dv"))
            newest = newest.join(done, (F.col("_k") == F.col("_dk")) & F.col("_v").eqNullSafe(F.col("_dv")), "left_anti")
        return source.join(newest, (F.col(key) == F.col("_k")) & F.col(version).eqNullSafe(F.col("_v"))).drop("_k", "_v")

    def publish(self, rows: DataFrame, base: int | None = None) -> int:
        """Add ``rows``, in place of what the target has of their keys, as the version after ``base`` (the current one, if not given).

        Give the version that the rows were computed against: if another run has published since, this fails.
        """
        base = self.current() if base is None else base
        return self._commit(base, [*self.folders(base), self._write(rows)])

    def compact(self) -> int:
        """The same rows in one folder, as the next version."""
        base = self.current()
        return self._commit(base, [self._write(self.read())]) if base else 0

    def vacuum(self, keep: int = 2, older_than_seconds: float = 7 * 86400) -> int:
        """Delete folders that none of the last ``keep`` versions names and no running job can still own; their number."""
        now, last = self.current(), int(time.time() * 1000 - older_than_seconds * 1000)
        used = {f for n in range(max(1, now - keep + 1), now + 1) for f in self.folders(n)}
        old = [f.getPath() for f in self._list("data") if f.getPath().getName() not in used and f.getModificationTime() < last]
        return sum(bool(self._fs.delete(p, True)) for p in old)

    def _write(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/data/{name}")
        return name

    def _commit(self, base: int, folders: list[str]) -> int:
        name = f"versions/{base + 1:08d}"
        fresh = self._at(f"versions/_{uuid.uuid4().hex}")
        out = self._fs.create(fresh)
        out.write(bytearray(" ".join(folders), "ascii"))
        out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                os.link(fresh.toUri().getPath(), self._at(name).toUri().getPath())  # a local rename would replace what is there
            else:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._hadoop)
                context.rename(fresh, self._at(name), self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except (FileExistsError, Py4JJavaError) as e:
            raise RuntimeError(f"version {base + 1} was published by another run") from e
        finally:
            self._fs.delete(fresh, False)
        return base + 1
