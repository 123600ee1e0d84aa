"""Keyed table with upserts, deletes and compaction (a hash with field set and field delete).

Rows are dealt to ``buckets`` by a hash of the key. A micro-batch appends its changes below ``changes/epoch=<epoch>/bucket=<bucket>``; a
deletion is a change without a value (a tombstone). Compaction folds the changes of one bucket into a new base of
that bucket and then marks it:

    base/<bucket>/<epoch>/     the bucket's rows after all changes up to that epoch
    marks/<bucket>/<epoch>     an empty file, made when that base is complete

A reader takes the base of the greatest mark of each bucket and the changes of later epochs, so what it reads after a compaction
does not depend on the number of epochs before. Every step can be repeated: a change folder is replaced
as a whole by a micro-batch that runs again, a base without a mark is not read and is written anew, and what the marks have made
useless is removed last. The marks are ``buckets`` names; nothing else is listed on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: str, key_type: str, value: str, value_type: str, buckets: int = 8):
        self.spark, self.path, self.key, self.value, self.buckets = spark, path, key, value, buckets
        self.row = f"`{key}` {key_type}, `{value}` {value_type}"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- writing

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def write_batch(self, batch: DataFrame, epoch: int, order: list[str] | None = None, op: str | None = None) -> None:
        """The changes of one micro-batch: the last one per key along ``order`` (without it a key has one row). ``op``: a boolean
        column, false for a deletion."""
        live = F.col(op) if op else F.lit(True)
        row = F.struct(live.alias("live"), F.when(live, F.col(self.value)).alias("v"))
        if order:
            last = batch.groupBy(self.key).agg(F.max_by(row, F.struct(*order)).alias("r"))
        else:
            last = batch.select(self.key, row.alias("r"))
        out = last.select(self.key, F.col("r.v").alias(self.value), F.col("r.live").alias("live"), self._bucket().alias("bucket"))
        out.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/changes/epoch={int(epoch):09d}")

    # -- reading

    def _names(self, folder: str) -> list[str]:
        at = self._path(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def epochs(self) -> list[int]:
        return [int(n.partition("=")[2]) for n in self._names("changes")]

    def folded(self) -> dict[int, int]:
        """The last epoch in the base of each bucket that has one."""
        return {int(b): max(map(int, marks)) for b in self._names("marks") if (marks := self._names(f"marks/{b}"))}

    def _read(self, base: dict[int, int], bucket: int | None = None) -> DataFrame:
        """The rows of all buckets (or one): the bases and all later changes, the last state of every key."""
        least = -1 if bucket is None and len(base) < self.buckets else min(base.values(), default=-1)
        parts = [self.spark.createDataFrame([], f"{self.row}, live boolean, epoch long")]
        if base:
            paths = [f"{self.path}/base/{b}/{e:09d}" for b, e in base.items()]
            parts.append(self.spark.read.schema(self.row).parquet(*paths).withColumns({"live": F.lit(True), "epoch": F.lit(-1).cast("long")}))
        epochs = [e for e in self.epochs() if e > least]
        if epochs:
            log = self.spark.read.schema(f"{self.row}, live boolean, epoch long, bucket int").option("basePath", f"{self.path}/changes")
            log = log.parquet(*[f"{self.path}/changes/epoch={e:09d}" for e in epochs])
            # a bucket's changes count from its base on; epoch and bucket are folders, so only those are read
            after = F.lit(-1)
            for b, e in base.items():
                after = F.when(F.col("bucket") == b, F.lit(e)).otherwise(after)
            log = log.where(F.col("epoch") > after) if bucket is None else log.where((F.col("bucket") == bucket) & (F.col("epoch") > base.get(bucket, -1)))
            parts.append(log.select(self.key, self.value, "live", "epoch"))
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        last = every.groupBy(self.key).agg(F.max_by(F.struct("live", self.value), "epoch").alias("r"))
        return last.where("r.live").select(self.key, F.col(f"r.{self.value}").alias(self.value))

    def current(self) -> DataFrame:
        return self._read(self.folded())

    # -- compaction

    def compact(self) -> None:
        """Fold the changes of every bucket into its base, one bucket after the other, and remove what nobody reads any more."""
        epochs = self.epochs()
        if not epochs:
            return
        for b in range(self.buckets):
            self.compact_bucket(b, max(epochs))
        self.vacuum()

    def compact_bucket(self, bucket: int, upto: int) -> None:
        mark = self.folded()
        if mark.get(bucket, -1) >= upto:
            return
        rows = self._read({bucket: mark[bucket]} if bucket in mark else {}, bucket)
        rows.write.mode("overwrite").parquet(f"{self.path}/base/{bucket}/{upto:09d}")
        self._mark(bucket, upto)

    def _mark(self, bucket: int, upto: int) -> None:
        self._fs.create(self._path(f"{self.path}/marks/{bucket}/{upto:09d}"), True).close()

    def vacuum(self) -> None:
        """Remove bases, marks and changes that the greatest marks have replaced."""
        mark = self.folded()
        for b, e in mark.items():
            for kind in ("base", "marks"):
                for old in self._names(f"{kind}/{b}"):
                    if int(old) < e:
                        self._fs.delete(self._path(f"{self.path}/{kind}/{b}/{old}"), True)
        if len(mark) == self.buckets:
            for old in self.epochs():
                if old <= min(mark.values()):
                    self._fs.delete(self._path(f"{self.path}/changes/epoch={old:09d}"), True)
