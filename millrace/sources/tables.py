"""Sinks and readers: versioned tables, CSV logs, JSON lines, JDBC."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import CRAWL_LOG, MAJOR_SEED, PROFILE


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name under spark.checkpoint.dir, which driver and executors share. Where that is unset on one machine, a temporary
    folder; on a cluster, an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        base = f"file://{own}"
    return f"{base.rstrip('/')}/millrace/{tag}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt over all cores by a hash of these columns. For rows of few bytes and costly work: a file of narrow rows is one task to the scan,
    however many rows it has."""
    spark = df.sparkSession
    n = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *by)


def write_version(df: DataFrame, path: str, version: str, again: bool = False) -> str:
    """A whole new version of a table, made the current one by a marker once it is complete; a reader sees one or the other. With
    `again` a version that is there is written anew, as by a batch that runs a second time."""
    df.write.mode("overwrite" if again else "error").parquet(f"{path}/v={version}")
    fs, marker = _fs(df.sparkSession, f"{path}/_current_{version}")
    fs.create(marker, True).close()
    return version


def rewritten(df: DataFrame, path: str) -> DataFrame:
    """df written to a folder and read back: it is computed once, whatever reads it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def last_version(spark: SparkSession, path: str, before: str | None = None) -> str | None:
    """The version whose marker is the last by name, of those below `before`; None where there is none."""
    fs, p = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    found = [n.removeprefix("_current_") for n in names if n.startswith("_current_")]
    return max((v for v in found if before is None or v < before), default=None)


def read_version(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """A version, or the last one."""
    return spark.read.parquet(f"{path}/v={version or last_version(spark, path)}")


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_indexed(df: DataFrame, path: str, by: str, key: str, buckets: int, bloom: tuple[str, ...] = ()) -> None:
    """A table that is found by `by` and `key` without a scan: folders by `by` and a bucket of the key, rows in order of the key, and Bloom
    filters of the key and of the columns `bloom` in the files. Null keys lie in a bucket as well."""
    writer = df.withColumn("__bucket", _bucket(key, buckets)).repartition(by, "__bucket").sortWithinPartitions(by, "__bucket", key).write.partitionBy(by, "__bucket")
    for c in (key, *bloom):
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def scan_indexed(spark: SparkSession, path: str, by: str, values: list, key: str, keys: list, buckets: int) -> DataFrame:
    """The rows with one of these values and keys: of the files only those of the folders concerned are opened."""
    of = [r[0] for r in spark.createDataFrame([(k,) for k in keys], f"k {spark.read.parquet(path).schema[key].dataType.simpleString()}").select(_bucket("k", buckets)).distinct().collect()]
    return spark.read.parquet(path).where(F.col(by).isin(values) & F.col("__bucket").isin(of) & F.col(key).isin(keys)).drop("__bucket")


def write_members(df: DataFrame, path: str, members: str, row: str, buckets: int) -> None:
    """An inverted index of a list column: (member, row), found by the member's bucket."""
    write_indexed(df.select(F.explode(F.array_distinct(members)).alias("member"), F.col(row).alias("row"), F.lit(0).alias("part")), path, "part", "member", buckets)


def holding(df: DataFrame, path: str, member: str, row: str, buckets: int) -> DataFrame:
    """The rows of df whose list holds the member, by its index."""
    found = scan_indexed(df.sparkSession, path, "part", [0], "member", [member], buckets).select(F.col("row").alias(row)).distinct()
    return df.join(found, row, "left_semi")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Tag profiles from JSON lines."""
    return spark.read.schema(PROFILE).json(path)


def read_major_seed(spark: SparkSession, path: str) -> DataFrame:
    """Seed rows of the majors from CSV."""
    return spark.read.csv(path, header=True, schema=MAJOR_SEED)


def read_crawl_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=CRAWL_LOG, timestampFormat="yyyy-MM-dd HH:mm:ss[.SSSSSS][X]")


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")


def read_text_table(spark: SparkSession, path: str, schema, form: str) -> DataFrame:
    """A table written as csv or json, read with its schema given, so that the files are read once."""
    options = {"header": True} if form == "csv" else {}
    return spark.read.schema(schema).format(form).options(**options).load(path)


def reset(spark: SparkSession, path: str, version: str) -> str:
    """A new version of the table without rows; earlier versions stay readable by name."""
    return write_version(read_version(spark, path).limit(0), path, version)


def majors_from_seed(seed: DataFrame) -> DataFrame:
    """Rows of the dimension from seed rows (code, name, group, holland as a comma-separated list), the first of each code."""
    return seed.groupBy("code").agg(F.min(F.struct("name", "group", "holland")).alias("x")).select(
        F.col("code").alias("major_code"), "x.name", F.col("x.group").alias("major_group"), F.substring("code", 1, 3).alias("major_group_code"), T.csv_list("x.holland").alias("holland_types"),
        F.lit(4).cast("smallint").alias("study_duration"), F.lit("bachelor").alias("degree_level"), F.lit(True).alias("is_active"),
    )


def masked(url: str) -> str:
    """A connection URL without its password."""
    return re.sub(r"(://[^:/@]+:)[^@]+@", r"\1***@", url)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_jdbc_parts(spark: SparkSession, url: str, table: str, column: str, parts: int, quote: str = '"', **options: str) -> DataFrame:
    """A table in parts that are read side by side: ranges of a whole-number column between its least and largest value, which the database is
    asked for first, with the column between `quote`. Rows whose column is null are in the first part."""
    low, high = read_jdbc(spark, url, f"(SELECT MIN({quote}{column}{quote}) AS lo, MAX({quote}{column}{quote}) AS hi FROM {table}) bounds", **options).first()
    if low is None or low == high:
        return read_jdbc(spark, url, table, **options)
    return read_jdbc(spark, url, table, partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts), **options)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, **options).save()
