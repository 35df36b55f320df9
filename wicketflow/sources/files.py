"""Tables on disk: typed CSV reads, overwrites, one folder per key, drifting headers."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path, schema: T.StructType | str) -> DataFrame:
    """CSV with a header, in the schema's own column order."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_parquet(spark: SparkSession, path, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by=()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_per_key(df: DataFrame, path: str, key: str | list[str], fmt: str = "parquet",
                  mode: str = "overwrite") -> None:
    """One folder per key value (folders within folders for several keys).

    Rebalancing lets adaptive execution gather small keys and split a key that
    holds a large share of the rows over many tasks.
    """
    keys = [key] if isinstance(key, str) else key
    (df.hint("rebalance", *map(F.col, keys)).write.mode(mode).partitionBy(*keys)
     .option("header", True).format(fmt).save(path))


def header_shapes(spark: SparkSession, paths) -> dict[tuple[str, ...], list[str]]:
    """The files of each header, from one distributed pass over the texts.

    A task sends on the first line of each file whose beginning it reads, and files of equal
    header meet before the driver sees them: one job, however many files there are. What the
    driver gets is the list of files, which it needs to plan the scans. Empty files have no
    header and no rows.
    """
    lines = spark.read.text(list(paths)).where("_metadata.file_block_start = 0").select(
        "value", "_metadata.file_path")

    def first_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            files = batch.column("file_path").to_pylist()
            heads = [i for i, f in enumerate(files) if f != (files[i - 1] if i else last)]
            if files:
                last = files[-1]
            yield batch.take(pa.array(heads, pa.int64()))

    found = (lines.mapInArrow(first_lines, "value string, file_path string")
             .groupBy(F.regexp_replace("value", "^\ufeff", "").alias("header"))
             .agg(F.collect_list("file_path").alias("files")).collect())
    shapes: dict[tuple[str, ...], list[str]] = {}
    for r in found:
        header = tuple(next(csv.reader([r.header]), ()))
        shapes.setdefault(header, []).extend(unquote(f) for f in sorted(r.files))
    return shapes


def read_csv_any_header(spark: SparkSession, paths, schema: str,
                        aliases: dict[str, str] | None = None) -> DataFrame:
    """CSV files of one kind whose headers differ in order, or name a column differently.

    `paths` are files or folders. Files of one header shape form one scan, columns go by
    name, and aliases (`{"file name": "schema name"}`) are renamed. A column that a shape
    lacks is null. No file with a header gives an empty table.
    """
    aliases = aliases or {}
    shapes = header_shapes(spark, paths)
    if not shapes:
        return spark.createDataFrame([], schema)
    fields = T.StructType.fromDDL(schema)
    types = {f.name: f.dataType for f in fields}
    parts = []
    for header, files in shapes.items():
        # A canonical column wins over its alias when a file has both.
        named = {c: c for c in header if c in types}
        named.update({c: aliases[c] for c in header
                      if c in aliases and aliases[c] not in named.values()})
        file_schema = T.StructType([
            T.StructField(c, types[named[c]] if c in named else T.StringType()) for c in header])
        df = read_csv(spark, files, file_schema)
        parts.append(df.select(*[F.col(c).alias(n) for c, n in named.items()]))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in whole.columns}
    return whole.withColumns(missing).select(*fields.names)
