"""Writers: Parquet (also by date), CSV with header, one-row JSON, and a manifest of written tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, single_file: bool = False) -> None:
    """S3: overwrite a Parquet table; ``single_file`` is for channel-sized results only."""
    out = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)


def write_by_date(df: DataFrame, path: str, date: str = "date") -> None:
    """S3: a Parquet table with one folder per date; only the dates that ``df`` holds are replaced.

    A job that is run again for some days thus leaves the others as they are.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite a CSV folder with a header line per file."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_json_summary(summary: DataFrame, path: str) -> None:
    """Overwrite a folder holding a one-row summary as JSON."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def write_manifest(spark: SparkSession, tables: dict[str, str], path: str) -> None:
    """Overwrite a JSON folder with one row per written Parquet table: name, rows and a checksum of its content.

    The checksum doesn't depend on the order of rows; doubles count to six places. Equal manifests mean equal tables.
    """
    rows = [(name, *_checksum(spark.read.parquet(where))) for name, where in sorted(tables.items())]
    spark.createDataFrame(rows, "name string, rows bigint, checksum string").coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> dict[str, tuple[int, str]]:
    rows = spark.read.schema("name string, rows bigint, checksum string").json(path).collect()
    return {r["name"]: (r["rows"], r["checksum"]) for r in rows}


def _checksum(table: DataFrame) -> tuple[int, str]:
    def cell(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        # adding 0 makes -0.0 and 0.0 alike
        return F.round(value, 6) + 0.0 if isinstance(field.dataType, T.DoubleType) else value

    cells = [cell(f) for f in sorted(table.schema, key=lambda f: f.name)]
    total = F.sum(F.xxhash64(*cells).cast("decimal(38,0)"))
    count, checksum = table.agg(F.count(F.lit(1)), F.coalesce(total, F.lit(0)).cast("string")).first()
    return count, checksum
