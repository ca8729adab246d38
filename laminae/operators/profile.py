"""Table profiles: every column's statistics from one scan."""

from __future__ import annotations

import fnmatch
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name fragments of identifier columns, and the profile's limits.
ID_FRAGMENTS = ["_id", "id_", "_uuid", "uuid_", "_key", "key_"]
NUMERIC_TYPES = ["int", "bigint", "float", "double", "decimal", "numeric"]
MAX_CATEGORIES = 30
SAMPLE_ROWS = 10
SAMPLE_VALUES = 3
SAMPLE_WIDTH = 15
HISTOGRAM_BINS = 10

EXACT_FIELDS = ["total_count", "null_count", "min_value", "max_value", "mean_value", "stddev_value"]
APPROX_FIELDS = ["unique_count", "q1", "median", "q3", "histogram"]
LEVELS = {
    "NONE": [],
    "SIMPLE": ["total_count", "null_count", "unique_count", "min_value", "max_value", "mean_value"],
    "DETAILED": ["total_count", "null_count", "unique_count", "min_value", "max_value", "mean_value", "stddev_value", "q1", "median", "q3", "histogram"],
}


def classify(name: str, dtype: T.DataType) -> str:
    """array, timestamp, boolean, id, numeric or categorical, from the type text and the name."""
    text = dtype.simpleString()
    if "array" in text:
        return "array"
    if "timestamp" in text:
        return "timestamp"
    if "boolean" in text:
        return "boolean"
    if any(p in name.lower() for p in ID_FRAGMENTS) and ("bigint" in text or "string" in text):
        return "id"
    return "numeric" if any(t in text for t in NUMERIC_TYPES) else "categorical"


def profiled_columns(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if not f.name.startswith(("_", "#"))]


def _measures(f: T.StructField, kind: str, approx: bool) -> dict[str, Column]:
    c = F.col(f"`{f.name}`")
    text = lambda x: x.cast("string")
    out: dict[str, Column] = {"null_count": F.sum(F.when(c.isNull(), 1).otherwise(0))}
    if kind in ("numeric", "timestamp"):
        out |= {"min_value": text(F.min(c)), "max_value": text(F.max(c))}
    if kind == "numeric":
        out |= {"mean_value": F.avg(c), "stddev_value": F.stddev_samp(c)}
    if not approx or kind == "array":
        return out
    out["unique_count"] = F.approx_count_distinct(c)
    if kind == "numeric":
        quartiles = F.percentile_approx(c, [0.25, 0.5, 0.75], 10_000)
        out |= {n: quartiles[i].cast("double") for i, n in enumerate(("q1", "median", "q3"))}
        out["histogram"] = F.to_json(F.histogram_numeric(c, F.lit(HISTOGRAM_BINS)))
    if kind == "timestamp":
        seconds = F.unix_timestamp(c.cast("timestamp"))
        out["histogram"] = F.to_json(F.histogram_numeric(seconds, F.lit(HISTOGRAM_BINS)))
    return out


_FIELD_TYPES = {
    "total_count": "bigint",
    "null_count": "bigint",
    "unique_count": "bigint",
    "min_value": "string",
    "max_value": "string",
    "mean_value": "double",
    "stddev_value": "double",
    "q1": "double",
    "median": "double",
    "q3": "double",
    "histogram": "string",
}


def profile(df: DataFrame, groups: list[Column] | None = None, approx: bool = True) -> DataFrame:
    """One row per column (and group): type, counts, extremes, moments and, with `approx`, distinct
    count, quartiles and histogram. A single aggregate computes all columns, then is unpivoted."""
    fields = profiled_columns(df)
    kinds = {f.name: classify(f.name, f.dataType) for f in fields}
    measured = {f.name: _measures(f, kinds[f.name], approx) for f in fields}
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, f in enumerate(fields):
        aggs += [m.alias(f"_m{i}_{n}") for n, m in measured[f.name].items()]
    names = EXACT_FIELDS + (APPROX_FIELDS if approx else [])
    grouped = df.groupBy(*(groups or []))
    wide = grouped.agg(*aggs)

    def entry(i: int, f: T.StructField) -> Column:
        cells = []
        for n in names:
            if n == "total_count":
                value = F.col("_total")
            elif n in measured[f.name]:
                value = F.col(f"_m{i}_{n}")
            else:
                value = F.lit(None)
            if n == "null_count":
                value = F.coalesce(value, F.lit(0))
            cells.append(value.cast(_FIELD_TYPES[n]).alias(n))
        kind = F.lit(kinds[f.name])
        if approx and kinds[f.name] == "categorical":
            kind = F.when(F.col(f"_m{i}_unique_count") >= MAX_CATEGORIES, "string").otherwise("categorical")
        return F.struct(F.lit(f.name).alias("column_name"), kind.alias("data_type"), *cells)

    kept = [c for c in wide.columns if not c.startswith("_m") and c != "_total"]
    return wide.select(*kept, F.inline(F.array(*[entry(i, f) for i, f in enumerate(fields)])))


def at_level(profiled: DataFrame, level: str) -> DataFrame:
    """NONE lists the columns, SIMPLE the light statistics, DETAILED everything."""
    if level not in LEVELS:
        raise ValueError(f"unknown profile level {level!r}")
    return profiled.select("column_name", "data_type", *[c for c in LEVELS[level] if c in profiled.columns])


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact counts of every value of the given columns: one unpivot, one aggregate."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    counted = (
        df.select(F.inline(cells)).where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    )
    small = counted.groupBy("column_name").agg(F.count(F.lit(1)).alias("_d")).where(F.col("_d") < MAX_CATEGORIES)
    return counted.join(small, "column_name", "left_semi")


def countable_columns(df: DataFrame) -> list[str]:
    """Boolean columns, and categorical ones that may have fewer distinct values than the limit.
    A sketch, taken with twice the limit, only spares wide key columns being counted value by value;
    `value_counts` decides on exact counts."""
    fields = profiled_columns(df)
    kinds = {f.name: classify(f.name, f.dataType) for f in fields}
    categorical = [n for n, k in kinds.items() if k == "categorical"]
    found = [n for n, k in kinds.items() if k == "boolean"]
    if categorical:
        row = df.agg(*[F.approx_count_distinct(f"`{n}`").alias(n) for n in categorical]).head()
        found += [n for n in categorical if 0 < row[n] < 2 * MAX_CATEGORIES]
    return found


def sample_rows(df: DataFrame) -> DataFrame:
    return df.limit(SAMPLE_ROWS)


def sample_values(df: DataFrame) -> dict[str, list[str]]:
    """Up to three distinct, shortened values per column, from the ten sample rows."""
    rows = sample_rows(df).collect()
    out: dict[str, list[str]] = {}
    for f in profiled_columns(df):
        seen: list[str] = []
        for row in rows:
            if row[f.name] is None or len(seen) == SAMPLE_VALUES:
                continue
            text = str(row[f.name])
            text = text if len(text) <= SAMPLE_WIDTH else f"{text[:SAMPLE_WIDTH]}..."
            if text not in seen:
                seen.append(text)
        out[f.name] = seen
    return out


def match_tables(available: list[str], patterns: list[str] | None) -> list[str]:
    """Exact names and `* ? []` patterns; none given means all."""
    if not patterns:
        return sorted(available)
    hit = [t for t in available if any(fnmatch.fnmatchcase(t, p) for p in patterns)]
    exact = [p for p in patterns if not any(ch in p for ch in "*?[") and p not in hit]
    return sorted(set(hit + exact))


def profile_tables(frames: dict[str, DataFrame], approx: bool = True) -> DataFrame:
    """Profiles of several tables as one frame; Spark runs the scans side by side."""
    parts = [profile(df, approx=approx).select(F.lit(name).alias("table_name"), "*") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


class ProfileCache:
    """Keeps a written profile while the table's files (path, size, mtime) stay the same."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self._seen = spark, base, {}

    def get(self, name: str, path: str, fmt: str = "parquet") -> DataFrame:
        from laminae.sources.files import list_folder, scan_files

        listing = list_folder(self.spark, path)
        mark = listing.agg(
            F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("b"), F.max("modificationTime").alias("m"),
            F.sum(F.xxhash64("path", "size_bytes", "modificationTime").cast("decimal(38,0)")).alias("h"),
        ).head()
        version = len(self._seen.get(name, []))
        if not version or self._seen[name][-1] != mark:
            self._seen.setdefault(name, []).append(mark)
            version += 1
            profile(scan_files(self.spark, path, fmt)).write.mode("overwrite").parquet(f"{self.base}/{name}/v={version}")
        return self.spark.read.parquet(f"{self.base}/{name}/v={version}")


def profile_files(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Profile of a folder with its file count and bytes; a missing or empty path gives an error row."""
    from pyspark.errors import AnalysisException

    from laminae.sources.files import list_folder, scan_files

    def failed(message: str) -> DataFrame:
        return spark.createDataFrame([(path, message)], "path string, error string")

    try:
        totals = list_folder(spark, path).agg(F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("b")).head()
        if not totals.n:
            return failed("no files in path")
        inference = {"inferSchema": "true"} if fmt == "csv" else {}
        df = scan_files(spark, path, fmt, **{**inference, **options})
    except AnalysisException as e:
        return failed(f"cannot read path: {e.getCondition()}")
    return profile(df).select(
        F.lit(path).alias("path"), F.lit(totals.n).alias("file_count"), F.lit(totals.b).alias("total_bytes"), "*", F.lit(None).cast("string").alias("error")
    )


def equi_width_histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Exact counts of equal-width bins between the column's extremes (one row back for them)."""
    lo, hi = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).head()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_low double, bin_high double, count bigint")
    c, width = F.col(column).cast("double"), (hi - lo) / bins
    place = F.least(F.floor((c - lo) / width), F.lit(bins - 1)) if width else F.lit(0)
    counted = df.where(c.isNotNull()).groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(
        "bin", (F.lit(lo) + F.col("bin") * width).alias("bin_low"), (F.lit(lo) + (F.col("bin") + 1) * width).alias("bin_high"), "count"
    )
