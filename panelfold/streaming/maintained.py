"""Group means that follow upserts: each batch adds its new values and takes back those it replaces.

The store has two tables below one folder: ``rows``, the last row of each key, partitioned by a hash of the key, and
``groups``, rows and sums by group, in versions.  A batch reads the buckets of its own keys only; the groups are
never summed again from all rows.  Sums are decimals, so that taking a value back leaves nothing of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelfold.operators.upsert import latest_per_key
from panelfold.session import stage
from panelfold.sources.files import path_exists
from panelfold.sources.sinks import claim_version, prune_versions, read_version, upsert_partitions, versions, write_version
from panelfold.streaming.incremental import query_id

BUCKET = "bucket"


@dataclass
class MaintainedMeans:
    """Means of ``measures`` by ``groups`` over the last row of each key, by ``order``.

    A row replaces the stored one of its key unless that one is later.  Values count with ``scale`` decimal places.
    ``buckets`` and the columns are fixed by the first batch.  Keys must not be NULL; a NULL measure counts for nothing.
    """

    spark: SparkSession
    root: str
    keys: Sequence[str]
    groups: Sequence[str]
    measures: Sequence[str]
    order: str
    buckets: int = 64
    scale: int = 6

    def _at(self, part: str) -> str:
        return f"{self.root.rstrip('/')}/{part}"

    def apply(self, batch: DataFrame, name: str) -> None:
        """Merge one batch; a batch that comes again under its name changes nothing.

        The groups are written before the rows, as a version of the batch's own: if it breaks off between the two, the
        version is there, and only the rows are merged once more.
        """
        bucket = F.pmod(F.hash(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets))
        columns = list(dict.fromkeys([*self.keys, *self.groups, *self.measures, self.order]))
        # dealt evenly first: a landed file is one task's, and that task would sort all of its rows by key
        dealt = batch.select(*columns).hint("rebalance")
        rows = latest_per_key(dealt, self.keys, [self.order]).withColumn(BUCKET, bucket)
        rows = stage(rows, "batch")
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # at most all buckets
        old = None
        if path_exists(self.spark, self._at("rows")):
            old = self.spark.read.schema(rows.schema).parquet(self._at("rows")).where(F.col(BUCKET).isin(touched))
            later = old.select(*[F.col(k).alias(f"__{k}") for k in self.keys], F.col(self.order).alias("__order"))
            same = F.lit(True)
            for k in self.keys:
                same = same & (F.col(k) == F.col(f"__{k}"))
            rows = stage(rows.join(later, same & (F.col("__order") > F.col(self.order)), "left_anti"), "accepted")
        at, parent = claim_version(self.spark, self._at("groups"), name)
        done = versions(self.spark, self._at("groups"))
        if not done or at > done[-1]:
            change = self._sums(rows, 1)
            if old is not None:
                change = change.unionByName(self._sums(old.join(rows.select(*self.keys), list(self.keys), "left_semi"), -1))
            if parent >= 0:
                change = change.unionByName(read_version(self.spark, self._at("groups"), parent))
            totals = [F.sum(c).cast(t).alias(c) for c, t in self._totals()]
            merged = change.groupBy(*self.groups).agg(*totals)
            write_version(merged.where("n <> 0"), self._at("groups"), at)
            prune_versions(self.spark, self._at("groups"), 3)
        if rows.head(1):
            upsert_partitions(self.spark, self._at("rows"), rows, [*self.keys, BUCKET], [c for c in columns if c not in self.keys], BUCKET)

    def _totals(self) -> list[tuple[str, str]]:
        return [("n", "long"), *[(f"{p}_{m}", t) for m in self.measures for p, t in (("n", "long"), ("s", f"decimal(38,{self.scale})"))]]

    def _sums(self, rows: DataFrame, sign: int) -> DataFrame:
        parts = [(F.count(F.lit(1)) * sign).alias("n")]
        for m in self.measures:
            value = F.col(m).cast(T.DecimalType(28, self.scale))
            parts += [(F.count(m) * sign).alias(f"n_{m}"), (F.coalesce(F.sum(value), F.lit(0)) * sign).cast(f"decimal(38,{self.scale})").alias(f"s_{m}")]
        return rows.groupBy(*self.groups).agg(*parts)

    def read(self) -> DataFrame:
        """(groups, n, means): rows and the mean of each measure; NULL where no value is known."""
        rows = read_version(self.spark, self._at("groups"))
        means = [F.try_divide(F.col(f"s_{m}").cast("double"), F.col(f"n_{m}")).alias(m) for m in self.measures]
        return rows.select(*self.groups, "n", *means)


def stream_means(store: MaintainedMeans, landing: str, schema: T.StructType, checkpoint: str, file_format: str = "parquet", files_per_batch: int | None = None) -> None:
    """Bring everything that has landed since the last run into the store, batch by batch, then stop."""
    reader = store.spark.readStream.schema(schema).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(batch: DataFrame, batch_id: int) -> None:
        store.apply(batch, f"{query_id(checkpoint, store.spark)}:{batch_id}")

    query = reader.load(landing).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
