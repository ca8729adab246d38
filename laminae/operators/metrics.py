"""Metric views: named dimensions and measures over a source with joins, queried by name."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How stored rows of a measure combine into coarser ones.
_COMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Join:
    """A left join; `on` is an expression over the parent's and this source's alias."""

    name: str
    source: DataFrame
    on: str | None = None
    using: list[str] = field(default_factory=list)
    joins: list["Join"] = field(default_factory=list)

    def __post_init__(self):
        if bool(self.on) == bool(self.using):
            raise ValueError(f"join {self.name}: give either on or using")


@dataclass(frozen=True)
class MetricView:
    """`combine` names the measures that may be answered from a pre-aggregate, with the way their
    stored values combine (sum, count, min or max)."""

    source: DataFrame
    dimensions: dict[str, str]
    measures: dict[str, str]
    filter: str | None = None
    joins: list[Join] = field(default_factory=list)
    combine: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if not self.dimensions or not self.measures:
            raise ValueError("a metric view needs at least one dimension and one measure")
        columns = joined_source(self).columns
        hidden = [d for d, e in self.dimensions.items() if d in columns and e != d]
        if hidden:
            raise ValueError(f"dimensions would hide source columns: {hidden}")


def joined_source(view: MetricView) -> DataFrame:
    """The source with its (nested) left joins; columns stay reachable as `alias.column`."""

    def attach(df: DataFrame, parent: str, joins: list[Join]) -> DataFrame:
        for j in joins:
            on = [F.col(f"{parent}.{c}") == F.col(f"{j.name}.{c}") for c in j.using] or [F.expr(j.on)]
            df = attach(df.join(j.source.alias(j.name), on, "left"), j.name, j.joins)
        return df

    df = attach(view.source.alias("source"), "source", view.joins)
    return df.where(F.expr(view.filter)) if view.filter else df


def query(
    view: MetricView,
    measures: list[str],
    dimensions: list[str] | None = None,
    where: str | None = None,
    order_by: str | list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Measures by the chosen dimensions. `where` speaks of dimension names and applies before the
    aggregation; no dimension gives one row. `order_by="ALL"` sorts by every output column."""
    unknown = [n for n in measures if n not in view.measures] + [n for n in dimensions or [] if n not in view.dimensions]
    if unknown:
        raise ValueError(f"not in the metric view: {unknown}")
    base = joined_source(view).withColumns({d: F.expr(e) for d, e in view.dimensions.items() if e != d})
    if where:
        base = base.where(F.expr(where))
    keys = [F.col(f"`{d}`") for d in dimensions or []]
    out = base.groupBy(*keys).agg(*[F.expr(view.measures[m]).alias(m) for m in measures])
    return _finish(out, order_by, limit)


def _finish(df: DataFrame, order_by, limit) -> DataFrame:
    if order_by == "ALL":
        df = df.orderBy(*[F.col(f"`{c}`") for c in df.columns])
    elif order_by:
        df = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return df.limit(limit) if limit else df


def materialize(view: MetricView, dimensions: list[str], measures: list[str]) -> DataFrame:
    """The pre-aggregate; the caller writes it."""
    return query(view, measures, dimensions)


def query_materialized(
    view: MetricView,
    stored: DataFrame,
    measures: list[str],
    dimensions: list[str] | None = None,
    order_by=None,
    limit: int | None = None,
) -> DataFrame:
    """Answer from the pre-aggregate when it holds the dimensions and the measures combine;
    otherwise from the source."""
    dims = dimensions or []
    held = set(dims) | set(measures) <= set(stored.columns)
    if not held or any(m not in view.combine for m in measures):
        return query(view, measures, dims, order_by=order_by, limit=limit)
    out = stored.groupBy(*[F.col(f"`{d}`") for d in dims]).agg(
        *[_COMBINE[view.combine[m]](F.col(f"`{m}`")).cast(stored.schema[m].dataType).alias(m) for m in measures]
    )
    return _finish(out, order_by, limit)
