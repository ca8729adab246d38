"""Ordered per-key computations that stay parallel when one key holds much of the table.

A plain window over `PARTITION BY key ORDER BY seq` sends a hot key to one task. The helpers here
partition by (key, segment), where `segment` is a monotone function of the order (a day of a
timestamp, a range of a counter), and carry what crosses a segment border through one summary row
per (key, segment). Only those summaries are ever grouped by the key alone.

Where a single segment of a key holds too many rows, borders inside it are chosen from the data: the rows
per key and segment are counted, and the quantiles of the order's columns divide the segments above
the limit, first by the first column, then, among its ties, by the next ones, again and again while parts are
above the limit. Only rows that equal each other in all columns that can be divided stay together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from laminae.session import cut_lineage

CELL_ROWS = 1_000_000  # a segment with more rows is divided
PARTS, ROUNDS = 64, 2  # into so many parts, so often for each column of the order
FEW = 100_000  # so many rows at most are sent to every task


def same_keys(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of the key columns of two aliased frames."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def day_segment(column: str) -> Column:
    return F.date_trunc("day", F.col(column))


def celled(
    df: DataFrame, keys: list[str], segment: Column, order: list[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Add `_cell`, the struct of key and segment.

    Everything below partitions, groups and joins by this one column. As a struct it is never
    null, so plain equality is null-safe and Spark keeps the partitioning from pass to pass.

    With an `order`, segments of more than `limit` rows are divided along it. Without a limit a frame that is known
    to fit one partition is left as it is, since dividing it would gain nothing.
    """
    key = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    plain = df.withColumn("_cell", F.struct(*key, segment.alias("seg")))
    if not order or (limit is None and _fits_one_partition(df)):
        return plain
    return _divided(plain, order, limit or CELL_ROWS)


def _fits_one_partition(df: DataFrame) -> bool:
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    )


def _magnitude(df: DataFrame, column: str) -> Column | None:
    """A number that orders a column's values as they are ordered (nulls first); None where there is none."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(column))
    return F.col(column) if isinstance(kind, T.NumericType) else None


def _divided(df: DataFrame, order: list[str], limit: int) -> DataFrame:
    """Divide the cells of more than `limit` rows by quantiles of the order's columns. The counts and quantiles are
    made in the map tasks first; what is joined back is one row for each cell above the limit."""
    crowded = cut_lineage(df.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit), "crowded")
    shares = [i / PARTS for i in range(1, PARTS)]
    for value in [v for v in (_magnitude(df, c) for c in order) if v is not None for _ in range(ROUNDS)]:
        if crowded.isEmpty():
            break
        inside = df.join(crowded.select("_cell"), "_cell", "left_semi")
        borders = inside.groupBy("_cell").agg(F.array_distinct(F.percentile_approx(value, shares, 10_000)).alias("_borders"))
        borders = cut_lineage(borders.select(F.col("_cell").alias("_whole"), "_borders"), "borders")
        joined = df.join(borders, F.col("_cell") == F.col("_whole"), "left")
        # equal values stay in one part; nulls come first, as in an ascending order
        below = F.coalesce(F.size(F.filter("_borders", lambda b: b < value)), F.lit(0))
        part = F.when(F.col("_borders").isNull() | value.isNull(), F.lit(-1)).otherwise(below)
        fields = [f.name for f in df.schema["_cell"].dataType.fields if f.name != "seg"]
        finer = F.struct(*[F.col(f"_cell.{f}").alias(f) for f in fields], F.struct(F.col("_cell.seg").alias("s"), part.alias("p")).alias("seg"))
        split = joined.withColumns({"_finer": finer, "_met": F.col("_borders").isNotNull()}).drop("_cell", "_whole", "_borders")
        split = split.withColumnRenamed("_finer", "_cell")
        counted = split.where("_met").groupBy("_cell").agg(F.count(F.lit(1)).alias("n"))
        crowded = cut_lineage(counted.where(F.col("n") > limit), "crowded")
        df = split.drop("_met")
    return df


def few(df: DataFrame, label: str) -> DataFrame:
    """The frame, written first so that its size is known: FEW rows go to every task when they are joined, whatever
    the session's own limit, so that the large side stays where it is and no task gets all rows of a key."""
    kept = cut_lineage(df, label)
    return F.broadcast(kept) if kept.count() <= FEW else kept


def _across(keys: list[str]):
    """Window over the cells of one key in order."""
    return W.partitionBy(*[F.col(f"_cell.k{i}") for i in range(len(keys))]).orderBy("_cell.seg")


def _attach(local: DataFrame, summary: DataFrame, columns: dict[str, Column], kept: list[str]) -> DataFrame:
    """Join rows with their cell's summary. Rows are already partitioned and sorted by cell, so
    only the summaries move (or are broadcast when they are small)."""
    joined = local.alias("l").join(summary.alias("r"), F.col("l._cell") == F.col("r._cell"), "left")
    return joined.select(*[F.col(f"l.{c}") for c in kept], *[c.alias(n) for n, c in columns.items()])


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    payload: list[str],
    segment: Column | None = None,
    prev: str = "_prev",
    next: str = "_next",
    limit: int | None = None,
) -> DataFrame:
    """Add the payload of the preceding and following row of the same key (null at the ends).

    Without `segment` the frame's own `_cell` column is used and kept, so that several passes share
    one shuffle.
    """
    source = df if segment is None else celled(df, keys, segment, order, limit)
    within = W.partitionBy("_cell").orderBy(*order)
    local = source.withColumn("_payload", F.struct(*payload))
    local = local.withColumns({prev: F.lag("_payload").over(within), next: F.lead("_payload").over(within)})

    position = F.struct(*order)
    borders = source.groupBy("_cell").agg(
        F.min_by(F.struct(*payload), position).alias("_first"), F.max_by(F.struct(*payload), position).alias("_last")
    )
    borders = borders.select(
        "_cell", F.lag("_last").over(_across(keys)).alias("_before"), F.lead("_first").over(_across(keys)).alias("_after")
    )
    added = {
        prev: F.coalesce(F.col(f"l.{prev}"), F.col("r._before")),
        next: F.coalesce(F.col(f"l.{next}"), F.col("r._after")),
    }
    return _attach(local, borders, added, df.columns)


def carry_last(
    df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, segment: Column | None = None, limit: int | None = None
) -> DataFrame:
    """The last non-null value of the key up to each row: inside the cell by a window, from before it by one
    row for each cell."""
    source = (df if segment is None else celled(df, keys, segment, order, limit)).withColumn("_value", value)
    within = W.partitionBy("_cell").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    before = _across(keys).rowsBetween(W.unboundedPreceding, -1)
    local = source.withColumn("_local", F.last("_value", ignorenulls=True).over(within))
    newest = source.groupBy("_cell").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order))).alias("_last"))
    carried = newest.select("_cell", F.last("_last", ignorenulls=True).over(before).alias("_before"))
    return _attach(local, carried, {name: F.coalesce(F.col("l._local"), F.col("r._before"))}, df.columns)


def running_sum(
    df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, segment: Column | None = None, limit: int | None = None
) -> DataFrame:
    """Running total of an integer per key: inside the cell by a window, before it by a summary."""
    source = df if segment is None else celled(df, keys, segment, order, limit)
    within = W.partitionBy("_cell").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    before = _across(keys).rowsBetween(W.unboundedPreceding, -1)
    local = source.withColumn("_local", F.sum(value).over(within))
    totals = source.groupBy("_cell").agg(F.sum(value).alias("_n"))
    offsets = totals.select("_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return _attach(local, offsets, {name: F.col("l._local") + F.col("r._offset")}, df.columns)


def with_positions(
    df: DataFrame, keys: list[str], order: list[str], segment: Column, name: str = "_position", limit: int | None = None
) -> DataFrame:
    """Number the rows of each key from 1 in the given (total) order."""
    return running_sum(df, keys, order, F.lit(1), name, segment, limit)


def rolling(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    segment: Column,
    preceding: int,
    aggregates: dict[str, Column],
    chunk_rows: int = 100_000,
    limit: int | None = None,
) -> DataFrame:
    """Aggregates over the current row and the `preceding` rows before it, per key.

    Rows are numbered, cut into chunks of `chunk_rows` and each chunk is given the last `preceding`
    rows of the chunk before it, so every frame is complete and no task sees a whole hot key.
    """
    if chunk_rows < preceding:
        raise ValueError("chunk_rows must not be smaller than the frame")
    numbered = with_positions(df, keys, order, segment, limit=limit)
    chunk = F.floor((F.col("_position") - 1) / chunk_rows)
    in_tail = F.pmod(F.col("_position") - 1, F.lit(chunk_rows)) >= chunk_rows - preceding
    homes = F.when(in_tail, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    spread = numbered.withColumn("_home", chunk).withColumn("_chunk", F.explode(homes))
    frame = W.partitionBy(*keys, "_chunk").orderBy("_position").rowsBetween(-preceding, 0)
    rolled = spread.withColumns({name: agg.over(frame) for name, agg in aggregates.items()})
    return rolled.where(F.col("_home") == F.col("_chunk")).drop("_home", "_chunk", "_position")


def sessions(
    df: DataFrame, keys: list[str], ts: str, tie: str, gap_seconds: int, segment: Column, limit: int | None = None
) -> DataFrame:
    """Add `_session` (1, 2, .. per key): a new one starts after `gap_seconds` without events.

    Session numbers are a running count of session starts. Both passes share one shuffle.
    """
    marked = with_neighbours(celled(df, keys, segment, [ts, tie], limit), keys, [ts, tie], [ts])
    quiet = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col(f"_prev.{ts}").cast("timestamp"))
    starts = F.when(F.col("_prev").isNull() | (quiet >= gap_seconds * 1_000_000), 1).otherwise(0)
    marked = marked.withColumn("_starts", starts).drop("_prev", "_next")
    return running_sum(marked, keys, [ts, tie], F.col("_starts"), "_session").drop("_cell", "_starts")


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated percentiles per group without holding a group's values in one buffer.

    1. a bounded sketch gives a narrow bracket of values around every wanted rank;
    2. one pass counts the rows below and inside each bracket, which proves whether it holds the
       rank (a bracket that does not is replaced by the whole range);
    3. only rows inside a bracket are counted by distinct value and ranked.

    The rows of the table are only met by what there is one row a group of, so few groups of many rows move no rows.
    """
    if not keys:
        whole = df.select(F.lit(1).alias("_all"), value)
        return exact_percentiles(whole, ["_all"], value, probs).drop("_all")
    accuracy = 10_000
    slack = 3.0 / accuracy
    src = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    edges = [max(p - slack, 0.0) for p in probs.values()] + [min(p + slack, 1.0) for p in probs.values()]
    k = len(probs)
    sketch = src.groupBy(*keys).agg(
        F.percentile_approx("_v", edges, accuracy).alias("_e"),
        F.count(F.lit(1)).alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    )
    entries = [
        F.struct(
            F.lit(n).alias("name"),
            F.lit(float(p)).alias("p"),
            (F.when(F.lit(p <= slack), F.col("_min")).otherwise(F.col("_e")[i])).alias("lo"),
            (F.when(F.lit(p >= 1 - slack), F.col("_max")).otherwise(F.col("_e")[k + i])).alias("hi"),
        )
        for i, (n, p) in enumerate(probs.items())
    ]
    brackets = few(sketch.select(*keys, "_n", "_min", "_max", *[e.alias(f"_b{i}") for i, e in enumerate(entries)]), "brackets")

    joined = src.alias("s").join(brackets.alias("b"), same_keys("s", "b", keys))
    # sums only: what is a struct would be aggregated by sorting all rows
    counted = joined.groupBy(*[F.col(f"b.{c}").alias(c) for c in keys]).agg(
        *[F.sum(F.when(F.col("_v") < F.col(f"_b{i}.lo"), 1).otherwise(0)).alias(f"_below{i}") for i in range(k)],
        *[
            F.sum(F.when(F.col("_v").between(F.col(f"_b{i}.lo"), F.col(f"_b{i}.hi")), 1).otherwise(0)).alias(f"_in{i}")
            for i in range(k)
        ],
    )
    proofs = counted.alias("c").join(brackets.alias("b"), same_keys("c", "b", keys)).select("c.*", *[F.col(f"b.{c}") for c in brackets.columns if c not in keys])

    def proven(i: int) -> Column:
        rank = (F.col("_n") - 1) * F.col(f"_b{i}.p")
        holds = (F.col(f"_below{i}") <= F.floor(rank)) & (
            F.ceil(rank) < F.col(f"_below{i}") + F.col(f"_in{i}")
        )
        return F.struct(
            F.col(f"_b{i}.name").alias("name"),
            rank.alias("rank"),
            F.when(holds, F.col(f"_b{i}.lo")).otherwise(F.col("_min")).alias("lo"),
            F.when(holds, F.col(f"_b{i}.hi")).otherwise(F.col("_max")).alias("hi"),
            F.when(holds, F.col(f"_below{i}")).otherwise(F.lit(0)).cast("long").alias("below"),
        )

    plan = few(proofs.select(*keys, F.array(*[proven(i) for i in range(k)]).alias("_plan")), "plan")
    near = (
        src.alias("s")
        .join(plan.alias("p"), same_keys("s", "p", keys))
        .select(*[F.col(f"s.{c}") for c in keys], "_v", F.explode("_plan").alias("_q"))
        .where(F.col("_v").between(F.col("_q.lo"), F.col("_q.hi")))
        .groupBy(*keys, F.col("_q.name").alias("_name"), F.col("_q.rank").alias("_rank"), F.col("_q.below").alias("_below"), "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    upto = W.partitionBy(*keys, "_name").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = near.withColumn("_hi", F.col("_below") + F.sum("_c").over(upto) - 1).withColumn(
        "_lo", F.col("_hi") - F.col("_c") + 1
    )
    covers = lambda r: (F.col("_lo") <= r) & (r <= F.col("_hi"))
    lower, upper = F.floor("_rank"), F.ceil("_rank")
    points = ranked.groupBy(*keys, "_name").agg(
        F.max(F.when(covers(lower), F.col("_v"))).alias("_a"),
        F.max(F.when(covers(upper), F.col("_v"))).alias("_b"),
        F.first(F.col("_rank") - F.floor("_rank")).alias("_f"),
    )
    at = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")
    return points.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == n, at)).alias(n) for n in probs])
