"""An imputed panel that is kept up to date: a load works on what it changes.

The store holds, below one folder,

* ``raw``: the rows as loaded, partitioned by bucket, a hash of the key;
* ``interpolated``: the same rows with their gaps filled inside each key, by bucket and period;
* ``cells``: by bucket, how many interpolated values lie in each grid cell of each period and measure;
* ``medians``: the median of each period and measure, and that of all periods;
* ``imputed``: the finished rows, by bucket and period.

A load upserts its rows into the buckets of its keys and interpolates those keys again.  Where that changes no
interpolated value of a bucket and period, nothing behind it is looked at.  Counts are taken again for the changed
buckets only and added to the stored ones; only periods whose counts changed are ranked again, and only
in the cells that hold the middle.  At last the partitions are rewritten in which a row changed, or in which a row is filled
by a median that moved.  The result equals imputing the whole history at once.

The finished rows are written before the counts, and the interpolated rows last: a load that breaks off is
repeated as a whole, finds the same changes and writes the same rows.  One load runs at a time.  Keys and periods must
not be NULL, and a load has one row for each of them (``latest_per_key`` settles repeated ones).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelfold.functions.scalars import half_even
from panelfold.operators.impute import interpolate
from panelfold.operators.quantiles import cell_counts, exact_quantiles, merged_counts
from panelfold.operators.sizing import join_small
from panelfold.session import stage
from panelfold.sources import sinks
from panelfold.sources.files import path_exists

BUCKET = "bucket"


@dataclass
class Load:
    """What a load did: buckets read, (bucket, period) partitions rewritten, periods ranked again, medians that moved."""

    buckets: list[int] = field(default_factory=list)
    rewritten: list[tuple] = field(default_factory=list)
    ranked: list = field(default_factory=list)
    moved: int = 0


@dataclass
class PanelStore:
    """An imputed panel below ``root``; ``buckets`` is fixed by the first load."""

    spark: SparkSession
    root: str
    keys: Sequence[str]
    period: str
    columns: Sequence[str]
    buckets: int = 64
    digits: int | None = None
    constant: float | None = None

    def _at(self, part: str) -> str:
        return f"{self.root.rstrip('/')}/{part}"

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        if path_exists(self.spark, self._at(part)):
            return self.spark.read.schema(schema).parquet(self._at(part))
        return self.spark.createDataFrame([], schema)

    def _schemas(self, rows: T.StructType) -> dict[str, T.StructType]:
        """Of the stored parts; partition columns come last."""
        key, when, bucket = [rows[k] for k in self.keys], rows[self.period], T.StructField(BUCKET, T.IntegerType())
        values = [T.StructField(c, T.DoubleType()) for c in self.columns]
        counts = [T.StructField("variable", T.StringType()), T.StructField("cell", T.LongType()), T.StructField("n", T.LongType())]
        extent = [T.StructField(c, T.DoubleType()) for c in ("lo", "hi")]
        return {
            "interpolated": T.StructType([*key, *values, bucket, when]),
            "imputed": T.StructType([*key, *values, bucket, when]),
            "cells": T.StructType([when, *counts, *extent, bucket]),
            "medians": T.StructType([when, T.StructField("variable", T.StringType()), T.StructField("median", T.DoubleType())]),
        }

    def read(self) -> DataFrame:
        """The imputed panel."""
        return self.spark.read.parquet(self._at("imputed")).select(*self.keys, self.period, *self.columns)

    def load(self, feed: DataFrame) -> Load:
        """Upsert the feed's rows, all of whose measures replace those of a known (key, period)."""
        keyed = [*self.keys, self.period]
        bucket = F.pmod(F.hash(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets))
        feed = stage(feed.select(*keyed, *[F.col(c).cast("double").alias(c) for c in self.columns], bucket.alias(BUCKET)), "feed")
        schemas = self._schemas(feed.schema)
        report = Load(buckets=sorted(r[0] for r in feed.select(BUCKET).distinct().collect()))  # at most all buckets
        if not report.buckets:
            return report
        sinks.upsert_partitions(self.spark, self._at("raw"), feed, [*keyed, BUCKET], list(self.columns), BUCKET)

        mine = F.col(BUCKET).isin(report.buckets)
        touched = stage(feed.select(*self.keys).distinct(), "touched-keys")
        raw = self.spark.read.schema(feed.schema).parquet(self._at("raw")).where(mine)
        new = interpolate(raw.join(touched, list(self.keys), "left_semi"), self.keys, self.period, self.columns)
        new = stage(new.select(*schemas["interpolated"].names), "interpolated")
        old = self._read("interpolated", schemas["interpolated"])
        changed = self._changed(old.where(mine).join(touched, list(self.keys), "left_semi"), new)
        changed = stage(changed, "changed")
        if not changed.head(1):
            return report

        # The buckets as they will be: other keys as stored, touched ones anew.
        renewed = stage(old.where(mine).join(touched, list(self.keys), "left_anti").unionByName(new), "renewed")
        counted = stage(self._counted(renewed, schemas["cells"]), "counted")
        medians, report.ranked = self._medians(schemas, report.buckets, old, renewed, counted, changed)
        known = self._read_medians(schemas["medians"])
        moved = stage(self._moved(known, medians), "moved")
        report.moved = moved.count()

        panel = old.where(~mine).unionByName(renewed)
        report.rewritten = self._rewrite(panel, changed, moved, medians)
        self._overwrite(counted, "cells", [BUCKET])
        sinks.write_version(medians, self._at("medians"), self._next_version())
        self._overwrite(renewed.join(changed.select(BUCKET, self.period).distinct(), [BUCKET, self.period], "left_semi"), "interpolated", [BUCKET, self.period])
        return report

    def _overwrite(self, rows: DataFrame, part: str, by: list[str]) -> None:
        # One file a partition, whatever the number of tasks.
        rows.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(self._at(part))

    def _next_version(self) -> int:
        done = sinks.versions(self.spark, self._at("medians"))
        return done[-1] + 1 if done else 0

    def _read_medians(self, schema: T.StructType) -> DataFrame:
        if sinks.versions(self.spark, self._at("medians")):
            return sinks.read_version(self.spark, self._at("medians")).select(*schema.names)
        return self.spark.createDataFrame([], schema)

    def _changed(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """(bucket, period, variable) in which a touched key's interpolated value is another one, or its row is new."""
        was = old.withColumn("__was", F.lit(True)).withColumnsRenamed({c: f"__{c}" for c in self.columns})
        both = new.join(was, [*self.keys, BUCKET, self.period], "left")
        differs = [F.when(F.col("__was").isNull() | ~F.col(c).eqNullSafe(F.col(f"__{c}")), F.lit(c)) for c in self.columns]
        each = both.select(BUCKET, self.period, F.explode(F.array_compact(F.array(*differs))).alias("variable"))
        return each.groupBy(BUCKET, self.period, "variable").agg(F.lit(1).alias("one")).drop("one")

    def _counted(self, rows: DataFrame, schema: T.StructType) -> DataFrame:
        return cell_counts(rows, [BUCKET, self.period], self.columns).select(*schema.names)

    def _medians(self, schemas, buckets: list[int], old: DataFrame, renewed: DataFrame, counted: DataFrame, changed: DataFrame) -> tuple[DataFrame, list]:
        """All medians after the load, and the periods that were ranked again.

        A NULL period stands for all of them; that median is only looked for where some period has no value of a measure.
        """
        outside = ~F.col(BUCKET).isin(buckets)
        counts = self._read("cells", schemas["cells"]).where(outside).unionByName(counted)
        counts = stage(merged_counts(counts, [self.period]), "cell-counts")
        periods = sorted(r[0] for r in changed.select(self.period).distinct().collect())  # one a period
        again = F.col(self.period).isin(periods)
        panel = old.where(outside).unionByName(renewed)
        found = exact_quantiles(panel.where(again), [self.period], self.columns, [0.5], counts=counts.where(again))
        found = found.select(self.period, "variable", F.col("quantiles")[0].alias("median"))
        kept = self._read_medians(schemas["medians"]).where(F.col(self.period).isNotNull() & ~again)
        medians = stage(kept.unionByName(found), "medians")
        if self.constant is None:
            n_periods = panel.select(self.period).distinct().count()
            full = {r[0] for r in medians.groupBy("variable").count().where(F.col("count") == n_periods).select("variable").collect()}
            gaps = [c for c in self.columns if c not in full]
            if gaps:
                every = merged_counts(counts.where(F.col("variable").isin(gaps)), [])
                all_rows = exact_quantiles(panel, [], gaps, [0.5], counts=every)
                none = F.lit(None).cast(medians.schema[self.period].dataType).alias(self.period)
                medians = stage(medians.unionByName(all_rows.select(none, "variable", F.col("quantiles")[0].alias("median"))), "medians")
        return medians, periods

    def _moved(self, known: DataFrame, medians: DataFrame) -> DataFrame:
        """(period, variable) whose median is another one than before."""
        was = known.select(F.col(self.period).alias("p"), F.col("variable").alias("v"), F.col("median").alias("was"))
        both = medians.join(was, F.col(self.period).eqNullSafe(F.col("p")) & (F.col("variable") == F.col("v")), "full_outer")
        both = both.where(~F.col("median").eqNullSafe(F.col("was")))
        return both.select(F.coalesce(self.period, "p").alias(self.period), F.coalesce("variable", "v").alias("variable"))

    def _rewrite(self, panel: DataFrame, changed: DataFrame, moved: DataFrame, medians: DataFrame) -> list[tuple]:
        """Write the partitions of ``imputed`` that differ; returns them."""
        shifted = {(r[0], r[1]) for r in moved.collect()}  # one a period and measure
        overall = [v for p, v in shifted if p is None]
        by_period: dict[str, list] = {}
        for p, v in shifted:
            if p is not None:
                by_period.setdefault(v, []).append(p)
        uses = [F.col(v).isNull() & F.col(self.period).isin(ps) for v, ps in by_period.items()] + [F.col(v).isNull() for v in overall]
        where = changed.select(BUCKET, self.period).distinct()
        if uses:
            where = where.union(panel.where(reduce(lambda a, b: a | b, uses)).select(BUCKET, self.period).distinct()).distinct()
        places = sorted((r[0], r[1]) for r in where.collect())  # one a partition
        chosen = stage(self.spark.createDataFrame(places, where.schema), "partitions")
        near = F.col(BUCKET).isin(sorted({b for b, _ in places})) & F.col(self.period).isin(sorted({p for _, p in places}))
        rows = panel.where(near).join(chosen, [BUCKET, self.period], "left_semi")
        self._overwrite(self._completed(rows, medians), "imputed", [BUCKET, self.period])
        return places

    def _completed(self, rows: DataFrame, medians: DataFrame) -> DataFrame:
        pick = [F.max(F.when(F.col("variable") == c, F.col("median"))).alias(f"{c}__median") for c in self.columns]
        wide = medians.where(F.col(self.period).isNotNull()).groupBy(self.period).agg(*pick)
        joined = join_small(rows, wide, [self.period], "left")
        last: dict[str, Column] = {c: F.lit(self.constant).cast("double") for c in self.columns}
        if self.constant is None:
            every = {r["variable"]: r["median"] for r in medians.where(F.col(self.period).isNull()).collect()}  # one a measure
            last = {c: F.lit(every.get(c)).cast("double") for c in self.columns}

        def complete(c: str) -> Column:
            out = F.coalesce(F.col(c), F.col(f"{c}__median"), last[c])
            return out if self.digits is None else half_even(out, self.digits)

        return joined.withColumns({c: complete(c) for c in self.columns}).drop(*[f"{c}__median" for c in self.columns])

