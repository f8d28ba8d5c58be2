"""Writers: tables, versioned upserts and small artefacts."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelfold.functions.scalars import half_even
from panelfold.operators.quality import table_counts
from panelfold.operators.upsert import ACTION, merge_upsert, upsert_counts
from panelfold.session import stage
from panelfold.sources.files import path_exists, read_csv, read_parquet, without_nan

log = logging.getLogger(__name__)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its types; absent columns are NULL, an overflow fails the job."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def create_tables(spark: SparkSession, schemas: Mapping[str, T.StructType], database: str = "default") -> None:
    """Create the Parquet tables that do not exist yet; existing ones are left alone."""
    for name, schema in schemas.items():
        full = f"{database}.{name}"
        if not spark.catalog.tableExists(full):
            spark.createDataFrame([], schema).write.format("parquet").saveAsTable(full)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a Parquet table by ``df`` and return it as read back.  NaN is written as NULL."""
    without_nan(df).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return read_parquet(df.sparkSession, path, own=True)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """Write a table that is dealt by its keys into sorted buckets, and return it as a reader sees it.

    Tables of as many buckets by the same keys join and aggregate on them without a shuffle.  One file a bucket is
    written, so the files' order is that of the keys; a key with very many rows makes its bucket large, so
    take keys that are (nearly) unique, as those of facts are.
    """
    spark = df.sparkSession
    dealt = without_nan(df).repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return spark.table(table)


def sync_csv(spark: SparkSession, folder: str, names: Sequence[str], out: str) -> DataFrame:
    """Replace one table per CSV; a missing file is reported and skipped.  Returns the row counts."""
    loaded = {}
    for name in names:
        source = f"{folder.rstrip('/')}/{name}.csv"
        if not path_exists(spark, source):
            log.warning("no file for %s, skipped", name)
            continue
        loaded[name] = replace_table(read_csv(spark, source), f"{out.rstrip('/')}/{name}")
    return table_counts(loaded)


def _numbers(spark: SparkSession, pattern: str) -> list[int]:
    """Version numbers of the folders that match."""
    root = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(root)
    names = [str(s.getPath()).split("/version=")[1] for s in (found or [])]
    return sorted(int(n.split("/")[0]) for n in names)


def versions(spark: SparkSession, table: str) -> list[int]:
    """Completed versions of a versioned table, oldest first."""
    return _numbers(spark, f"{table}/version=*/_SUCCESS")


def prune_versions(spark: SparkSession, table: str, keep: int) -> list[int]:
    """Delete all but the last ``keep`` completed versions; returns those deleted."""
    old = versions(spark, table)[: -keep or None] if keep > 0 else []
    for v in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/version={v}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return old


def read_version(spark: SparkSession, table: str, at: int | None = None) -> DataFrame:
    """A version of the table, the last completed one by default."""
    done = versions(spark, table)
    if not done:
        raise FileNotFoundError(f"{table} has no completed version")
    return spark.read.parquet(f"{table}/version={done[-1] if at is None else at}")


def write_version(df: DataFrame, table: str, at: int) -> None:
    """Write one version.  A reader sees it only when its success marker is in place."""
    df.write.mode("overwrite").parquet(f"{table}/version={at}")


def upsert_version(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    at: int,
    order: Sequence[str] = (),
    touch: Sequence[str] = (),
    stamp: Sequence[str] = (),
    parent: int | None = None,
) -> None:
    """Merge ``source`` into version ``parent`` (the last one before ``at``) and write version ``at``.

    Running it again with the same numbers gives the same version, so a replay changes nothing.
    """
    before = [v for v in versions(spark, table) if v < at] if parent is None else [parent] if parent >= 0 else []
    if before:
        merged = merge_upsert(read_version(spark, table, before[-1]), source, keys, update, order, touch, stamp)
    else:
        empty = spark.createDataFrame([], source.schema)
        merged = merge_upsert(empty, source, keys, update, order, touch, stamp)
    write_version(merged, table, at)


def claim_version(spark: SparkSession, table: str, load: str) -> tuple[int, int]:
    """(version, parent) of a load, which is named once and for all: a replay gets the numbers it had before.

    A new load gets the number after every version there is or that another load has claimed, and the last
    completed version as its parent (-1: none).  Claims are kept beside the data; one load runs at a time.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    claims = fs.Path(f"{table}/_claims")
    files = claims.getFileSystem(spark._jsc.hadoopConfiguration())
    name = f"{hashlib.sha256(load.encode()).hexdigest()}"
    found = files.globStatus(fs.Path(f"{table}/_claims/{name}.version=*.parent=*"))
    if found:
        version, parent = str(found[0].getPath().getName()).split(".version=")[1].split(".parent=")
        return int(version), int(parent)
    taken = [int(str(s.getPath().getName()).split(".version=")[1].split(".")[0]) for s in (files.globStatus(fs.Path(f"{table}/_claims/*.version=*")) or [])]
    done = versions(spark, table)
    version, parent = max([-1, *taken, *_numbers(spark, f"{table}/version=*")]) + 1, done[-1] if done else -1
    files.mkdirs(claims)
    files.create(fs.Path(claims, f"{name}.version={version}.parent={parent}"), False).close()
    return version, parent


def upsert_partitions(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    partition: str,
    order: Sequence[str] = (),
    touch: Sequence[str] = (),
    stamp: Sequence[str] = (),
) -> DataFrame:
    """Merge into a table partitioned by a key column, rewriting only the partitions the source touches.

    For large tables and small loads: untouched partitions are neither read nor written.  Columns the load
    does not have keep their values, new ones are added.  The partition column is read in the source's
    type, so a text such as ``01`` stays one.  The source is staged once, so that its partitions and its rows
    are those of one evaluation, and so are the merged rows, since a job cannot overwrite what it reads.  Each
    partition's files are replaced by themselves: a reader during the load may see some old and some new ones.
    Returns the rewritten partitions as rows.
    """
    if partition not in keys:
        raise ValueError("the partition column must be one of the keys: a key must not move between partitions")
    source = stage(source, "source")
    touched = stage(source.select(partition).distinct(), "touched")
    timed = [c for c in (*touch, *stamp) if c not in source.columns]
    fields = [*source.schema.fields, *[T.StructField(c, T.TimestampType()) for c in dict.fromkeys(timed)]]
    if path_exists(spark, table):
        known = {f.name: f for f in spark.read.parquet(table).schema.fields}
        kind = source.schema[partition]
        schema = T.StructType([*[f for n, f in known.items() if n != partition], kind])
        old = spark.read.schema(schema).parquet(table).join(touched, partition, "left_semi")
        old = old.withColumns({f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in known})
    else:
        old = spark.createDataFrame([], T.StructType(fields))
    merged = stage(merge_upsert(old, source, keys, update, order, touch, stamp), "merged")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(table)
    return touched


# --- loads and deletes in any order ----------------------------------------------------------------

LOADED, KEPT = "_at", "_kept"  # number of the load a row is from, and whether it is not deleted


def _deletions(spark: SparkSession, table: str) -> DataFrame | None:
    """(keys, _gone): the last deletion of each key."""
    where = f"{table}.deleted"
    return read_version(spark, where) if versions(spark, where) else None


def delete_ordered(spark: SparkSession, table: str, doomed: DataFrame, keys: Sequence[str], partition: str, at: int) -> None:
    """Delete the rows of some keys (a table's keys or some of them) that loads up to number ``at`` have brought.

    The deletion is kept: a load with a smaller number that comes, or comes again, later does not bring the rows
    back, one with a larger number does.  Deletions of a table name the same key columns.  Only the partitions that hold
    such rows are rewritten, in which the rows are marked.
    """
    new = stage(doomed.select(*keys, F.lit(at).cast("long").alias("_gone")).distinct(), "deleted")
    old = _deletions(spark, table)
    every = new if old is None else old.unionByName(new).groupBy(*keys).agg(F.max("_gone").alias("_gone"))
    done = versions(spark, f"{table}.deleted")
    write_version(stage(every, "deletions"), f"{table}.deleted", done[-1] + 1 if done else 0)
    prune_versions(spark, f"{table}.deleted", 2)
    if not path_exists(spark, table):
        return
    rows = spark.read.parquet(table)
    old_rows = (F.col(LOADED) <= at) & F.col(KEPT)
    hit = [r[0] for r in rows.where(old_rows).join(new, list(keys), "left_semi").select(partition).distinct().collect()]  # one a partition
    if hit:
        named = new.select(*[F.col(k).alias(f"__{k}") for k in keys], F.lit(True).alias("__gone"))
        same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in keys])
        near = rows.where(F.col(partition).isin(hit)).join(named, same, "left")
        kept = F.col(KEPT) & ~(F.coalesce("__gone", F.lit(False)) & (F.col(LOADED) <= at))
        out = stage(near.withColumn(KEPT, kept).select(*rows.columns), "kept")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(table)


def upsert_ordered(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str], update: Sequence[str], partition: str, at: int) -> None:
    """``upsert_partitions`` for loads that may come late or again: number ``at`` decides, not the time of arrival.

    A row replaces one of the same key from a load with a smaller number or the same, and is left out if a deletion
    of a larger number names its key.
    """
    rows = source
    gone = _deletions(spark, table)
    if gone is not None:
        names = [c for c in gone.columns if c != "_gone"]
        later = gone.where(F.col("_gone") >= at).select(*[F.col(c).alias(f"__{c}") for c in names])
        rows = rows.join(later, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__{c}") for c in names]), "left_anti")
    if path_exists(spark, table):
        newer = spark.read.parquet(table).where(F.col(LOADED) > at).select(*[F.col(k).alias(f"__{k}") for k in keys])
        rows = rows.join(newer, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in keys]), "left_anti")
    rows = stage(rows.withColumns({LOADED: F.lit(at).cast("long"), KEPT: F.lit(True)}), "ordered")
    if rows.head(1):
        upsert_partitions(spark, table, rows, keys, [*update, LOADED, KEPT], partition)


def read_ordered(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table written by ``upsert_ordered`` and ``delete_ordered``."""
    return spark.read.parquet(table).where(KEPT).drop(KEPT, LOADED)


def upsert_report(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows inserted, updated, unchanged and untouched by a merge."""
    return upsert_counts(merge_upsert(target, source, keys, update, order, action=True)).withColumnRenamed(ACTION, "action")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Model scores as JSON lines, rounded for display."""
    # Digits kept per score.
    digits = {"r2": 4, "rmse": 3, "mae": 3, "mape": 2}
    metrics.withColumns({c: half_even(c, d) for c, d in digits.items() if c in metrics.columns}).write.mode("overwrite").json(path)


def write_features(spark: SparkSession, features: Sequence[str], path: str) -> None:
    """The ordered feature list as JSON lines."""
    rows = [(i, f) for i, f in enumerate(features)]
    spark.createDataFrame(rows, "position int, feature string").coalesce(1).write.mode("overwrite").json(path)


def read_features(spark: SparkSession, path: str) -> list[str]:
    rows = spark.read.schema("position int, feature string").json(path).orderBy("position").collect()
    return [r["feature"] for r in rows]
