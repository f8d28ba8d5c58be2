"""Readers for landed feeds.  Schemas are explicit; NaN becomes NULL at this boundary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelfold.functions.scalars import nan_to_null


def without_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({f"{c}": nan_to_null(F.col(f"`{c}`")) for c in floating}) if floating else df


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Headed CSV.  Without a schema all columns are text, ready for ``coerce_numeric``.

    The header is checked against the schema, so a feed whose columns moved fails instead of
    shifting values.  The text ``NA`` is kept: it is a valid code.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    return without_nan(reader.csv(path))


def read_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, lines: bool = True) -> DataFrame:
    """JSON documents, one per line; with ``lines=False`` a document or an array of documents per file.

    Lines can be split over tasks, a file that is one document or array cannot.  Malformed input fails.
    """
    reader = spark.read.schema(schema).option("multiLine", not lines).option("mode", "FAILFAST")
    return without_nan(reader.json(path))


def read_pages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Paged API answers, one file per page, as text next to the file's name."""
    return spark.read.option("wholetext", True).text(path).select(
        F.col("_metadata.file_path").alias("page"), F.col("value").alias("body")
    )


def is_page(body: Column | str) -> Column:
    """Whether a text is a JSON array, as paged answers are; NULL for a NULL text."""
    text = F.col(body) if isinstance(body, str) else body
    return F.when(text.isNotNull(), F.try_parse_json(text).isNotNull() & F.ltrim(text).startswith("["))


def explode_pages(pages: DataFrame, body: str, record: T.StructType) -> DataFrame:
    """Records of ``[meta, [record, ...]]`` answers, with their place in the page.

    A page without records gives no rows, one that is not an array of JSON fails the job: filter on
    ``is_page`` first to set such pages aside.  Other columns of ``pages`` are kept.
    """
    rest = [c for c in pages.columns if c != body]
    broken = F.raise_error(F.concat(F.lit("not a page: "), F.substring(body, 1, 80))).cast("string")
    whole = F.when(F.coalesce(is_page(body), F.lit(True)), F.col(body)).otherwise(broken)
    records = F.from_json(F.get_json_object(whole, "$[1]"), T.ArrayType(record))
    return pages.select(*rest, F.posexplode(records).alias("at", "r")).select(*rest, "at", "r.*")


def read_parquet(spark: SparkSession, path: str | Sequence[str], cached: bool = False, own: bool = False) -> DataFrame:
    """Parquet table, kept in memory on request.  A missing path is an error.

    ``own`` is for tables this library has written, which hold no NaN: they are read as they are, so that
    filters on their numbers reach the scan.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    df = df if own else without_nan(df)
    return df.cache() if cached else df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return without_nan(spark.table(name))


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], split: tuple[str, int, int, int] | None = None
) -> DataFrame:
    """Database table; ``split`` is (numeric column, lowest, highest, partitions) for a parallel read."""
    if split is None:
        return without_nan(spark.read.jdbc(url, table, properties=dict(properties)))
    column, lo, hi, parts = split
    return without_nan(
        spark.read.jdbc(url, table, column=column, lowerBound=lo, upperBound=hi, numPartitions=parts, properties=dict(properties))
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whichever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_first_available(spark: SparkSession, name: str, folders: Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """A catalog table if there is one, else ``name.parquet`` or ``name.csv`` from the first folder that has it."""
    if spark.catalog.tableExists(name):
        return read_table(spark, name)
    for folder in folders:
        base = f"{folder.rstrip('/')}/{name}"
        if path_exists(spark, f"{base}.parquet"):
            return read_parquet(spark, f"{base}.parquet")
        if path_exists(spark, f"{base}.csv"):
            return read_csv(spark, f"{base}.csv", schema)
    raise FileNotFoundError(f"{name}: not in the catalog nor in {list(folders)}")
