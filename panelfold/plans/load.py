"""The load of the star schema: clean tables into the store, by keyed upserts, then counts and an audit."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelfold.operators.quality import WriteAudit, audit, table_counts
from panelfold.schemas import DIMENSION, FACTS, KEYS, STAMPS, TABLES, measures
from panelfold.sources import sinks

PERIOD = "year"


def _clean_schema(table: str) -> T.StructType:
    return T.StructType([f for f in TABLES[table].fields if f.name not in STAMPS])


def load_table(spark: SparkSession, root: str, table: str, clean: DataFrame, load: str) -> None:
    """Upsert clean rows into one table of the store.

    On a known key only the measures change; names, source labels and the time of the first load stay.
    The dimension is small and versioned; facts are partitioned by year, and only the years of the load
    are rewritten.  ``load`` names the load: repeating it changes nothing but the dimension's ``updated_at``.
    """
    rows = sinks.conform(clean, _clean_schema(table))
    where = f"{root.rstrip('/')}/{table}"
    if table == DIMENSION:
        stamped = rows.withColumns({c: F.lit(None).cast("timestamp") for c in ("created_at", "updated_at")})
        at, parent = sinks.claim_version(spark, where, load)
        sinks.upsert_version(
            spark, where, stamped, KEYS[table], measures(table), at, touch=["updated_at"], stamp=["created_at"], parent=parent
        )
    else:
        sinks.upsert_partitions(spark, where, rows, KEYS[table], measures(table), PERIOD, stamp=["loaded_at"])


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the store in the order and the types of its schema; a table never loaded is an error."""
    where = f"{root.rstrip('/')}/{table}"
    if table == DIMENSION:
        return sinks.read_version(spark, where).select(TABLES[table].names)
    fields = [f for f in TABLES[table].fields if f.name != PERIOD]
    return spark.read.schema(T.StructType([*fields, TABLES[table][PERIOD]])).parquet(where).select(TABLES[table].names)


def load_star(spark: SparkSession, root: str, clean: Mapping[str, DataFrame], load: str) -> dict[str, DataFrame]:
    """Load the given clean tables, the dimension first, and return the store's tables."""
    for table in (DIMENSION, *FACTS):
        if table in clean:
            load_table(spark, root, table, clean[table], load)
    return {t: read_table(spark, root, t) for t in (DIMENSION, *FACTS) if t in clean}


def load_audited(spark: SparkSession, root: str, clean: Mapping[str, DataFrame], limit_pct: float = 1.0) -> DataFrame:
    """First load of the given clean tables, each written and audited in one scan; returns the audit's rows."""
    reports = []
    for table in (DIMENSION, *FACTS):
        if table in clean:
            rows = sinks.conform(clean[table], _clean_schema(table))
            seen = WriteAudit(spark, table, rows.columns, PERIOD, limit_pct)
            sinks.replace_table(seen.of(rows), f"{root.rstrip('/')}/{table}", [PERIOD] if table != DIMENSION else [])
            reports.append(seen.report())
    return reduce(DataFrame.unionByName, reports)


def load_report(tables: Mapping[str, DataFrame], limit_pct: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Rows per table, and the audit of periods and empty cells."""
    return table_counts(tables), audit(tables, PERIOD, limit_pct)
