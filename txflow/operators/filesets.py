"""Table versions as sets of parquet files: merge and update by rewriting the files they touch, packing of small
files, versions, their expiry and orphans (CHG1, CHG2, CHG4, CHG5, CHG7, CHG8).

A table lives under one folder::

    data/write=<id>/<partition folders>/part-*.parquet    one folder for each write, never changed afterwards
    files/version=<n>/                                     the files that version n consists of, one row each

A change writes new files to a folder of its own and then the next version's list, so a write that is cut off leaves
nothing that any version names, and every version stays readable until its files go. What reaches the driver are file
names, as with any read of a table, and never rows.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.functions import values as V
from txflow.operators.changes import MergeCardinalityError, most_per_key
from txflow.operators.files import orphan_files, storage_listing
from txflow.session import work_dir, written_whole

FILES = "file_path string, path string, length bigint"


@dataclass
class Change:
    """What a change did to the files: the new version and how many files it kept, removed and added."""

    version: int
    kept: int
    removed: int
    added: int


class FileTable:
    """A table of versions under ``root``, partitioned by ``partition_by`` (columns of ``schema``)."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, partition_by: list[str] | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.partition_by = partition_by or []

    @classmethod
    def create(cls, df: DataFrame, root: str, partition_by: list[str] | None = None) -> FileTable:
        """A new table whose version 1 holds the rows of ``df``."""
        table = cls(df.sparkSession, root, df.schema, partition_by)
        table._commit(1, table._write(df))
        return table

    # --- versions ---------------------------------------------------------------

    @cached_property
    def _empty_files(self) -> DataFrame:
        return self.spark.createDataFrame([], FILES)

    def versions(self) -> list[int]:
        """The versions whose list is written whole, oldest first."""
        found, n = [], 1
        while written_whole(self.spark, f"{self.root}/files/version={n}"):
            found.append(n)
            n += 1
        return found

    def latest(self) -> int:
        return self.versions()[-1]

    def files(self, version: int) -> DataFrame:
        """file_path (as ``_metadata.file_path`` spells it), path, length of a version's files."""
        return self.spark.read.schema(FILES).parquet(f"{self.root}/files/version={version}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default. Partition folders and column statistics prune the scan."""
        return self._rows(self.files(version or self.latest()))

    def _rows(self, files: DataFrame) -> DataFrame:
        paths = [r["path"] for r in files.select("path").collect()]     # file names, as any read lists them
        if not paths:
            return self.spark.createDataFrame([], self.schema).withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
        return self.spark.read.schema(self.schema).option("basePath", f"{self.root}/data").parquet(*paths)

    def _plain(self, df: DataFrame) -> DataFrame:
        return df.select(*self.schema.names)

    def _write(self, df: DataFrame, dealt: bool = False) -> DataFrame:
        """New files with the rows of ``df``: one folder for this write. Without ``dealt`` rows are dealt by
        partition; a hot one is split at run time."""
        folder = f"{self.root}/data/write={uuid.uuid4().hex}"
        if self.partition_by and not dealt:
            df = df.hint("rebalance", *self.partition_by)
        w = self._plain(df).write
        (w.partitionBy(*self.partition_by) if self.partition_by else w).parquet(folder)
        return storage_listing(self.spark, folder).select("file_path", "path", "length")

    def _commit(self, version: int, files: DataFrame) -> None:
        # a list that was cut off is not a version: it is written anew
        files.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/files/version={version}")

    def _next(self, removed: DataFrame, added: DataFrame) -> Change:
        """The next version: the newest one's files without ``removed`` (file_path), and ``added``."""
        before = self.latest()
        old = self.files(before)
        kept = old.join(removed.select("file_path").distinct(), "file_path", "left_anti")
        self._commit(before + 1, kept.unionByName(added))
        both = old.select("file_path", F.lit(1).alias("o")).join(
            self.files(before + 1).select("file_path", F.lit(1).alias("n")), "file_path", "full")
        was, now, stayed = both.agg(F.count("o"), F.count("n"), F.count(F.col("o") + F.col("n"))).first()
        return Change(before + 1, stayed, was - stayed, now - stayed)

    # --- changes ----------------------------------------------------------------

    def append(self, df: DataFrame) -> Change:
        """The rows of ``df`` as new files."""
        return self._next(self._empty_files, self._write(df))

    def rollback(self, version: int) -> Change:
        """A new version with the files of an older one; nothing is written but the list."""
        return self._next(self.files(self.latest()), self.files(version))

    def merge(self, source: DataFrame, key: str = "id", update: list[str] | None = None,
              delete: Column | None = None) -> Change:
        """MERGE: rows whose key ``source`` has take its ``update`` columns (or go, where ``delete`` holds for the source
        row); source rows whose key the table lacks are added unless ``delete`` holds. A key that occurs twice in the
        source is refused; NULL keys never match.

        Only files that hold a matched key are rewritten. They are found by a scan of the key column, within the
        range of the source's keys, that reports ``_metadata.file_path``; all other files stay in the next
        version as they are.
        """
        update = update if update is not None else [c for c in source.columns if c != key and c in self.schema.names]
        gone = F.coalesce(delete, F.lit(False)) if delete is not None else F.lit(False)
        source = self._once(source.withColumn("_gone", gone), "merge_source")
        worst = most_per_key(source, key)
        if worst > 1:
            raise MergeCardinalityError(f"source has {worst} rows for one {key}")
        low, high = source.agg(F.min(key), F.max(key)).first()
        scan = self.read()
        keys = scan.filter(F.col(key).between(low, high)) if low is not None else scan.filter(F.lit(False))
        hits = self._once(keys.select(key, F.col("_metadata.file_path").alias("file_path"))
                          .join(source.select(key), key, "left_semi").distinct(), "merge_hits")
        touched = hits.select("file_path").distinct()

        src = source.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_src_{c}") for c in update], "_gone")
        rows = self._plain(self._rows(self.files(self.latest()).join(touched, "file_path", "left_semi")))
        matched = rows.join(src, F.col(key) == F.col("_key"), "left").filter(~F.coalesce("_gone", F.lit(False)))
        changed = matched.select(*[
            (F.when(F.col("_key").isNotNull(), F.col(f"_src_{c}")).otherwise(F.col(c)) if c in update else F.col(c)).alias(c)
            for c in self.schema.names])
        added = source.filter(~F.col("_gone")).join(hits.select(key).distinct(), key, "left_anti")
        return self._next(touched, self._write(changed.unionByName(self._plain(added))))

    def update(self, col: str, value: Column | object, where: Column | None = None) -> Change:
        """UPDATE t SET col = value [WHERE where]: only files with a row that ``where`` selects are rewritten; the
        condition is pushed to the scan that finds them."""
        v = value if isinstance(value, Column) else F.lit(value)
        scan = self.read()
        found = (scan if where is None else scan.filter(where)).select(F.col("_metadata.file_path").alias("file_path"))
        touched = self._once(found.distinct(), "update_files")
        rows = self._plain(self._rows(self.files(self.latest()).join(touched, "file_path", "left_semi")))
        new = v if where is None else F.when(where, v).otherwise(F.col(col))
        return self._next(touched, self._write(rows.withColumn(col, new.cast(self.schema[col].dataType))))

    def _once(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once to the shared folder: read by several branches, with a known size."""
        path = work_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # --- maintenance --------------------------------------------------------------

    def bins(self, target_bytes: int = V.TARGET_FILE_BYTES, small: float = 0.75) -> DataFrame:
        """file_path, path, length, folder, bin: the small files of each partition, packed in order of their names
        into bins of about ``target_bytes`` by a running sum of sizes. Files of at least ``small`` of the target are left
        out, and so is a bin of one file. A bin's size is under the target and one small file more."""
        from pyspark.sql import Window

        names = F.regexp_extract("path", "/data/write=[^/]+/(.*)$", 1)
        folder = F.regexp_replace(names, "[^/]*$", "")
        files = self.files(self.latest()).withColumn("folder", folder).filter(F.col("length") < F.lit(small * target_bytes))
        before = F.sum("length").over(Window.partitionBy("folder").orderBy("path")) - F.col("length")
        packed = files.withColumn("bin", F.floor(before / F.lit(target_bytes)).cast("int"))
        many = F.count("*").over(Window.partitionBy("folder", "bin"))
        return packed.withColumn("_n", many).filter("_n > 1").drop("_n")

    def compact(self, target_bytes: int = V.TARGET_FILE_BYTES, small: float = 0.75,
                sort_by: list[str] | None = None) -> Change:
        """CHG7: every bin of small files becomes one file; large files stay. One task writes one bin, about
        ``target_bytes``, whatever the partition's size."""
        chosen = self.bins(target_bytes, small).collect()              # file names of small files
        number = {x: i for i, x in enumerate(sorted({(r["folder"], r["bin"]) for r in chosen}))}
        plan = self.spark.createDataFrame([(r["file_path"], r["path"], r["length"], number[r["folder"], r["bin"]]) for r in chosen],
                                          f"{FILES}, bin int")
        if not chosen:
            return self._next(plan, self._empty_files)
        rows = self._rows(plan)
        of = plan.select(F.col("file_path").alias("_file"), "bin")
        dealt = (rows.select(*self.schema.names, F.col("_metadata.file_path").alias("_file")).join(of, "_file")
                 .repartitionById(len(number), F.col("bin")))
        keys = [*self.partition_by, *(sort_by or [])]
        dealt = dealt.sortWithinPartitions(*keys) if keys else dealt
        return self._next(plan, self._write(dealt, dealt=True))

    def expirable(self, keep: int = V.RETAIN_LAST_VERSIONS) -> DataFrame:
        """CHG5: file_path, path, length, added (its first version), last (its newest): the files that none of the
        newest ``keep`` versions needs. A report; the caller removes them."""
        versions = self.versions()
        every = self.spark.read.schema(f"{FILES}, version int").parquet(f"{self.root}/files").filter(
            F.col("version").isin(versions))
        kept = every.filter(F.col("version") > versions[-1] - keep).select("file_path").distinct()
        return (every.join(kept, "file_path", "left_anti").groupBy("file_path", "path", "length")
                .agg(F.min("version").alias("added"), F.max("version").alias("last")))

    def orphans(self, older_than: _dt.timedelta = _dt.timedelta(days=3), now: _dt.datetime | None = None) -> DataFrame:
        """CHG8: files under ``data`` that no version names and that are older than the floor: what writes that were cut off
        have left. A report; files of versions that may expire are not in it (see ``expirable``)."""
        live = self.spark.read.schema(f"{FILES}, version int").parquet(f"{self.root}/files").filter(
            F.col("version").isin(self.versions()))
        return orphan_files(self.spark, f"{self.root}/data", live.select("file_path"), older_than, now)
