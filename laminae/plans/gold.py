"""The star schema, and gold models in general."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminae.operators.quality import Rule, apply_rules
from laminae.operators.scd import apply_snapshot_scd2, first_history

Silver = dict[str, DataFrame]


@dataclass(frozen=True)
class Model:
    name: str
    build: Callable[[Silver], DataFrame]
    scd_type: int = 1
    natural_key: tuple[str, ...] = ()
    depends_on: tuple[str, ...] = ()
    track: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()

    @property
    def keeps_history(self) -> bool:
        """History needs a natural key; without one the model is rebuilt each time."""
        return self.scd_type == 2 and bool(self.natural_key)


def in_order(models: list[Model]) -> list[Model]:
    """Dependencies first; names outside the list are ignored, a cycle is an error."""
    named = {m.name: m for m in models}
    graph = {m.name: [d for d in m.depends_on if d in named] for m in models}
    try:
        return [named[n] for n in TopologicalSorter(graph).static_order()]
    except CycleError as e:
        raise ValueError(f"gold models depend on each other in a circle: {e.args[1]}") from e


def sql_model(raw: dict, spark: SparkSession) -> Model:
    """A model declared as SQL over silver table names."""

    def build(silver: Silver) -> DataFrame:
        for table in raw.get("source_tables", list(silver)):
            short = table.split(".")[-1]
            silver[short].createOrReplaceTempView(short)
        return spark.sql(raw["sql"])

    rules = tuple(Rule(r["name"], r["constraint"], r.get("action", "warn")) for r in (raw.get("quality") or {}).get("expectations", []))
    return Model(
        raw["name"], build, int(raw.get("scd_type", 1)), tuple(raw.get("natural_key") or ()), tuple(raw.get("depends_on") or ()),
        tuple(raw.get("track_history_columns") or ()), rules,
    )


def load_sql_models(folder: str, spark: SparkSession) -> list[Model]:
    docs = [yaml.safe_load(p.read_text()) for p in sorted(Path(folder).glob("*.yml"))]
    return [sql_model(d.get("gold_model") or d["model"], spark) for d in docs]


def refresh(model: Model, silver: Silver, stored: DataFrame | None, version: Column) -> DataFrame:
    """The model's next contents: rebuilt, or its history moved forward."""
    fresh = apply_rules(model.build(silver), list(model.rules))
    if not model.keeps_history:
        return fresh
    if stored is None:
        return first_history(fresh, version)
    return apply_snapshot_scd2(stored, fresh, list(model.natural_key), version, track=list(model.track) or None)


# ---- the sample star ---------------------------------------------------------------------------

# Span of the date dimension.
FIRST_DAY, LAST_DAY = "2010-01-01", "2030-12-31"


def dim_date(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    d = F.col("date_key")
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 DAY"))
    quarter_label = F.concat(F.lit("Q"), F.quarter(d).cast("string"))
    return spark.range(1).select(F.explode(days).alias("date_key")).withColumns(
        {
            "year": F.year(d),
            "quarter": F.quarter(d),
            "month": F.month(d),
            "day": F.day(d),
            "day_of_week": F.dayofweek(d),
            "week_of_year": F.weekofyear(d),
            "month_name": F.date_format(d, "MMMM"),
            "month_short": F.date_format(d, "MMM"),
            "day_name": F.date_format(d, "EEEE"),
            "is_weekend": F.dayofweek(d).isin(1, 7),
            "quarter_name": quarter_label,
            "year_quarter": F.concat_ws("-", F.year(d).cast("string"), quarter_label),
            "year_month": F.date_format(d, "yyyy-MM"),
        }
    )


def nations_with_region(silver: Silver) -> DataFrame:
    on = F.col("n_regionkey") == F.col("r_regionkey")
    return silver["nation"].join(silver["region"], on, "left")


def dim_region_nation(silver: Silver) -> DataFrame:
    return nations_with_region(silver).select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation_name"),
        F.col("n_regionkey").alias("region_key"), F.col("r_name").alias("region_name"),
    )


def _located(party: DataFrame, nation_column: str, silver: Silver) -> DataFrame:
    return party.join(nations_with_region(silver), F.col(nation_column) == F.col("n_nationkey"), "left")


def dim_customer(silver: Silver) -> DataFrame:
    names = {"c_custkey": "customer_key", "c_name": "customer_name", "c_acctbal": "account_balance", "c_mktsegment": "market_segment"}
    place = {"n_nationkey": "nation_key", "n_name": "nation_name", "r_name": "region_name"}
    located = _located(silver["customer"], "c_nationkey", silver)
    return located.select(*[F.col(c).alias(a) for c, a in {**names, **place}.items()])


def dim_supplier(silver: Silver) -> DataFrame:
    names = {"s_suppkey": "supplier_key", "s_name": "supplier_name", "s_acctbal": "supplier_balance"}
    place = {"n_nationkey": "nation_key", "n_name": "nation_name", "r_name": "region_name"}
    located = _located(silver["supplier"], "s_nationkey", silver)
    return located.select(*[F.col(c).alias(a) for c, a in {**names, **place}.items()])


def dim_part(silver: Silver) -> DataFrame:
    names = {"p_partkey": "part_key", "p_name": "part_name", "p_brand": "brand", "p_type": "part_type", "p_size": "part_size", "p_retailprice": "retail_price"}
    return silver["part"].select(*[F.col(c).alias(a) for c, a in names.items()])


def fact_order_line(silver: Silver) -> DataFrame:
    line, head = silver["lineitem"], silver["orders"]
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    text = lambda c: F.col(c).cast("string")
    return line.join(head, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(text("l_orderkey"), F.lit("-"), text("l_linenumber")).alias("order_line_key"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_key"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supplier_key"),
        F.to_date("o_orderdate").alias("order_date"),
        F.to_date("l_shipdate").alias("ship_date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extended_price"),
        F.col("l_discount").alias("discount_rate"),
        F.col("l_tax").alias("tax_rate"),
        net.alias("net_amount"),
        (net * (1 + F.col("l_tax"))).alias("gross_amount"),
        F.col("o_totalprice").alias("order_total_price"),
    )


def quality_kpis(silver: Silver, names: list[str] | None = None) -> DataFrame:
    """One row with the silver row counts, as scalar subqueries."""
    names = names or ["region", "nation", "customer", "orders", "lineitem"]
    spark = silver[names[0]].sparkSession
    count = lambda n: silver[n].agg(F.count(F.lit(1))).scalar().alias(f"silver_{n}_rows")
    return spark.range(1).select(*[count(n) for n in names])


def _keyed(column: str) -> tuple[Rule, ...]:
    return (Rule(f"{column}_not_null", f"{column} IS NOT NULL", "fail"),)


STAR = [
    Model("dim_region_nation", dim_region_nation, natural_key=("nation_key",), rules=_keyed("nation_key")),
    Model(
        "dim_customer", dim_customer, 2, ("customer_key",), ("dim_region_nation",),
        ("customer_name", "account_balance", "market_segment", "nation_key", "nation_name", "region_name"), _keyed("customer_key"),
    ),
    Model("dim_supplier", dim_supplier, natural_key=("supplier_key",), depends_on=("dim_region_nation",), rules=_keyed("supplier_key")),
    Model("dim_part", dim_part, natural_key=("part_key",), rules=_keyed("part_key")),
    Model(
        "fact_order_line", fact_order_line, depends_on=("dim_customer", "dim_part", "dim_supplier", "dim_region_nation"),
        rules=(*_keyed("order_line_key"), Rule("quantity_positive", "quantity > 0", "warn")),
    ),
    Model("pipeline_quality_kpis", quality_kpis, depends_on=("fact_order_line",)),
]
