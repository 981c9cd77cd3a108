"""Tables of one row per key that micro-batches add to: the newest row of a key counts, expired rows go.

Rows are dealt into buckets by the hash of their key. A micro-batch writes one delta folder, named after it, so that
writing it again changes nothing. After some deltas they are merged: of every bucket that a delta touched, the newest
row per key that has not expired is written to a new version; other buckets keep theirs. A small manifest, one row
per bucket, says which version counts and up to which micro-batch it holds; it is written last, beside the one
before, so readers see the old state or the new one. What two manifests no longer name is deleted.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import ordered
from tidewell.storage import delete, folders

MANIFEST = "bucket int, version bigint, upto bigint"
#: Stands in a manifest without buckets, which still says up to where deltas are merged.
NO_BUCKET = -1


@dataclass(frozen=True)
class KeyedTable:
    """keys: columns of the key; order: columns the newest row is greatest in, after that the micro-batch counts;
    expires: a timestamp column after which a row is gone."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    expires: str | None = None
    buckets: int = 16
    merge_after: int = 8

    def _bucket(self, columns: Iterable[Column | str] | None = None) -> Column:
        return F.pmod(F.xxhash64(*(columns or self.keys)), F.lit(self.buckets)).cast("int")

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())])

    def _manifest(self, spark: SparkSession) -> tuple[int, list]:
        """Number and rows of the manifest that counts; a row per bucket that was ever merged."""
        numbers = [int(name.partition("=")[2]) for name in folders(spark, f"{self.path}/manifest", "version=", complete=True)]
        if not numbers:
            return 0, []
        number = max(numbers)
        return number, spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/version={number}").collect()

    def _deltas(self, spark: SparkSession, after: int) -> list[int]:
        numbers = [int(name.partition("=")[2]) for name in folders(spark, f"{self.path}/delta", "batch=", complete=True)]
        return sorted(n for n in numbers if n > after)

    def write(self, rows: DataFrame, batch_id: int, now: Column | None = None) -> None:
        """Add the rows of a micro-batch. `now` is the instant for expiry; without it nothing expires on merging."""
        spark = rows.sparkSession
        _, known = self._manifest(spark)
        upto = max((r["upto"] for r in known), default=-1)
        if batch_id <= upto:
            return  # merged already
        out = ordered.latest(rows.select(*self.schema.fieldNames()), list(self.keys), self._newest(rows)) if self.order else rows
        out = out.select(*self.schema.fieldNames(), F.lit(batch_id).cast("bigint").alias("batch_id"), self._bucket().alias("bucket"))
        out.repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/delta/batch={batch_id}")
        if len(self._deltas(spark, upto)) >= self.merge_after:
            self.merge(spark, now)

    def _newest(self, rows: DataFrame) -> list[Column]:
        return [F.col(name) for name in (*self.order, "batch_id") if name in rows.columns]

    def _read(self, spark: SparkSession, known: list, deltas: list[int], wanted: list[int] | None) -> DataFrame:
        """All rows of the buckets, those of older deltas of a key among them."""
        base = [
            f"{self.path}/base/version={r['version']}/bucket={r['bucket']}" for r in known
            if r["bucket"] != NO_BUCKET and (wanted is None or r["bucket"] in wanted)
        ]
        kept = T.StructType(self._stored().fields[:-1])
        parts = [spark.read.schema(kept).parquet(*base)] if base else []
        for number in deltas:
            delta = spark.read.schema(self._stored()).parquet(f"{self.path}/delta/batch={number}")
            # Partition folders of other buckets are not listed among the files to read.
            delta = delta if wanted is None else delta.filter(F.col("bucket").isin(wanted))
            parts.append(delta.drop("bucket"))
        if not parts:
            return spark.createDataFrame([], kept)
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows

    def _current(self, rows: DataFrame, now: Column | None) -> DataFrame:
        newest = ordered.latest(rows, list(self.keys), self._newest(rows))
        if now is None or self.expires is None:
            return newest
        return newest.filter(F.col(self.expires).isNull() | (F.col(self.expires) > now))

    def read(self, spark: SparkSession, now: Column | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The newest row of each key that has not expired by `now`, of all buckets or some."""
        _, known = self._manifest(spark)
        deltas = self._deltas(spark, max((r["upto"] for r in known), default=-1))
        return self._current(self._read(spark, known, deltas, buckets), now).drop("batch_id")

    def asked(self, requests: DataFrame) -> list[int]:
        """The buckets of the keys in `requests`; at most as many numbers as there are buckets."""
        return sorted(r["bucket"] for r in requests.select(self._bucket().alias("bucket")).distinct().collect())

    def merge(self, spark: SparkSession, now: Column | None = None) -> None:
        """Write the buckets that deltas touched anew, without what has expired, and drop the deltas."""
        number, known = self._manifest(spark)
        upto = max((r["upto"] for r in known), default=-1)
        deltas = self._deltas(spark, upto)
        if not deltas:
            return
        touched = sorted({
            int(name.partition("=")[2]) for d in deltas for name in folders(spark, f"{self.path}/delta/batch={d}", "bucket=")
        })
        mine = [r for r in known if r["bucket"] in touched]
        rows = self._current(self._read(spark, mine, deltas, touched), now).withColumn("bucket", self._bucket())
        target = f"{self.path}/base/version={number + 1}"
        rows.repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
        written = {int(name.partition("=")[2]) for name in folders(spark, target, "bucket=")}
        # A bucket all of whose rows have expired has no folder and leaves the manifest.
        after = [(r["bucket"], r["version"], deltas[-1]) for r in known if r["bucket"] not in (*touched, NO_BUCKET)]
        after += [(bucket, number + 1, deltas[-1]) for bucket in sorted(written)]
        after = after or [(NO_BUCKET, number + 1, deltas[-1])]
        manifest = spark.createDataFrame(after, MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.path}/manifest/version={number + 1}")
        self._clean(spark, number + 1, upto)

    def _clean(self, spark: SparkSession, number: int, merged_before: int) -> None:
        """Delete what neither this manifest nor the one before needs."""
        for name in folders(spark, f"{self.path}/delta", "batch="):
            if int(name.partition("=")[2]) <= merged_before:
                delete(spark, f"{self.path}/delta/{name}")
        needed = set()
        for name in folders(spark, f"{self.path}/manifest", "version="):
            version = int(name.partition("=")[2])
            if version < number - 1:
                delete(spark, f"{self.path}/manifest/{name}")
            else:
                rows = spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/{name}").collect()
                needed |= {(r["version"], r["bucket"]) for r in rows}
        for name in folders(spark, f"{self.path}/base", "version="):
            version, buckets = int(name.partition("=")[2]), folders(spark, f"{self.path}/base/{name}", "bucket=")
            kept = [b for b in buckets if (version, int(b.partition("=")[2])) in needed]
            for bucket in buckets:
                if bucket not in kept:
                    delete(spark, f"{self.path}/base/{name}/{bucket}")
            if not kept and version < number:
                delete(spark, f"{self.path}/base/{name}")
