"""Table and file writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Managed table, or external below `path/name` when a path is given."""
    writer = df.write.format(fmt).mode(mode)
    if path:
        writer = writer.option("path", f"{path.rstrip('/')}/{name.split('.')[-1]}")
    writer.saveAsTable(name)


def table_from_files(spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options) -> None:
    spark.read.format(fmt).options(**options).load(path).write.mode("overwrite").saveAsTable(name)


def export_files(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """CSV gets a header line unless told otherwise."""
    defaults = {"header": "true"} if fmt == "csv" else {}
    df.write.format(fmt).options(**{**defaults, **options}).mode("overwrite").save(path)


def write_partitioned(df: DataFrame, path: str, columns: list[str]) -> None:
    """One folder per value. Rows are rebalanced by the partition columns: each folder gets few
    files, and AQE splits the share of a dominant value over several writers."""
    names = ", ".join(f"`{c}`" for c in columns)
    rebalanced = df.sparkSession.sql(f"SELECT /*+ REBALANCE({names}) */ * FROM {{rows}}", rows=df)
    rebalanced.write.partitionBy(*columns).mode("overwrite").parquet(path)


SAMPLE, BITS = 20_000, 6


def write_clustered(df: DataFrame, path: str, keys: list[str], partitions: int | None = None) -> None:
    """Files in the order of one to four keys, so that the minima and maxima of their statistics skip files. With
    several keys rows are laid along a Z-curve through the keys' ranks: a filter on any one of k keys opens about the
    k-th root of one part in as many as there are files, at most twice that, where a sort by the first key alone skips
    nothing for the others."""
    if not 1 <= len(keys) <= 4:
        raise ValueError("give one to four clustering keys")
    if len(keys) == 1:
        ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
        ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
        return
    name = "_z"
    while name in df.columns:
        name += "_"
    placed = df.withColumn(name, z_order(df, keys))
    ranged = placed.repartitionByRange(partitions, name, *keys) if partitions else placed.repartitionByRange(name, *keys)
    ranged.sortWithinPartitions(name, *keys).drop(name).write.mode("overwrite").parquet(path)


def z_order(df: DataFrame, keys: list[str], bits: int = BITS, sample: int = SAMPLE) -> Column:
    """The place of a row on a Z-curve: the bits of its keys' ranks, the first bits of all keys in front.

    Ranks are coarse: the place among 2 ** bits ranges that hold equal numbers of a bounded sample of rows
    (by their hash). The sample decides how well files skip, never what they hold. Nulls come first."""
    chosen = df.select(*keys).orderBy(F.xxhash64(*keys)).limit(sample).collect()
    ranks = []
    for k in keys:
        values = sorted(r[k] for r in chosen if r[k] is not None)
        borders = sorted({values[i * len(values) >> bits] for i in range(1, 1 << bits)}) if values else []
        ranks.append(F.when(F.col(k).isNotNull(), _rank(F.col(k), borders, 0, len(borders))).otherwise(0))
    place = F.lit(0).cast("long")
    for level in range(bits - 1, -1, -1):
        for rank in ranks:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(rank, level).bitwiseAND(F.lit(1)).cast("long"))
    return place


def _rank(value: Column, borders: list, low: int, high: int) -> Column:
    """How many borders are not above the value: a binary search written as nested conditions."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value < F.lit(borders[middle]), _rank(value, borders, low, middle)).otherwise(_rank(value, borders, middle + 1, high))


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> None:
    """Bucketed and sorted table: later joins and keyed applies on `keys` need no shuffle. Meant for
    state tables, whose keys are unique; a column with a dominant value would fill one bucket."""
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(name)


def compact(spark: SparkSession, source: str, target: str, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Rewrite many small files as few of about `target_bytes`. Returns the file count aimed at."""
    from laminae.sources.files import list_folder

    total = list_folder(spark, source, "*.parquet").agg(F.sum("size_bytes").alias("b")).head().b or 0
    files = max(1, -(-total // target_bytes))
    spark.read.parquet(source).repartition(files).write.mode("overwrite").parquet(target)
    return files
