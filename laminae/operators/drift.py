"""Schema drift: detect, forbid or absorb."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Audit columns that never count as drift, and the kinds of change.
IGNORED_COLUMNS = [
    "_ingestion_timestamp",
    "_source_system",
    "_source_schema",
    "_source_table",
    "_load_type",
    "_silver_timestamp",
    "_is_current",
]
CHANGE_KINDS = ["add_column", "drop_column", "type_change"]


class SchemaDriftError(Exception):
    """A schema change that the table's contract does not allow."""


@dataclass(frozen=True)
class Drift:
    added: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)
    retyped: list[str] = field(default_factory=list)

    def __bool__(self) -> bool:
        return bool(self.added or self.dropped or self.retyped)

    def by_kind(self) -> dict[str, list[str]]:
        return dict(zip(CHANGE_KINDS, (self.added, self.dropped, self.retyped)))


def _leaves(schema: T.StructType, prefix: str = "") -> dict[str, str]:
    """Leaf paths with their types, so a change inside a struct, array or map is named precisely."""
    out: dict[str, str] = {}

    def walk(path: str, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f"{path}.{f.name}", f.dataType)
        elif isinstance(kind, T.ArrayType) and _nested(kind.elementType):
            walk(f"{path}[]", kind.elementType)
        elif isinstance(kind, T.MapType) and _nested(kind.valueType):
            out[f"{path}{{key}}"] = kind.keyType.simpleString()
            walk(f"{path}{{}}", kind.valueType)
        else:
            out[path] = kind.simpleString()

    for f in schema.fields:
        walk(f"{prefix}{f.name}", f.dataType)
    return out


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def detect(incoming: T.StructType, existing: T.StructType | None) -> Drift:
    """No target yet means nothing can have drifted."""
    if existing is None:
        return Drift()
    keep = lambda leaves: {k: v for k, v in leaves.items() if re.split(r"[.\[{]", k)[0] not in IGNORED_COLUMNS}
    new, old = keep(_leaves(incoming)), keep(_leaves(existing))
    return Drift(
        added=sorted(new.keys() - old.keys()),
        dropped=sorted(old.keys() - new.keys()),
        retyped=[f"{c}: {old[c]} -> {new[c]}" for c in sorted(new.keys() & old.keys()) if new[c] != old[c]],
    )


def enforce(drift: Drift, allowed: list[str]) -> None:
    refused = {k: v for k, v in drift.by_kind().items() if v and k not in allowed}
    if refused:
        raise SchemaDriftError("; ".join(f"{kind} not allowed: {names}" for kind, names in refused.items()))


def check(incoming: DataFrame, existing: DataFrame | None, mode: str = "auto_evolve", allowed: list[str] | None = None) -> Drift:
    drift = detect(incoming.schema, existing.schema if existing is not None else None)
    if drift and mode == "strict":
        enforce(drift, allowed if allowed is not None else ["add_column"])
    return drift


def drift_record(spark: SparkSession, table: str, schema: T.StructType, drift: Drift, at: str) -> DataFrame:
    """One log row: what changed, with the hash and text of the incoming schema."""
    text = schema.json()
    row = [(table, hashlib.sha256(text.encode()).hexdigest(), text, str(drift.by_kind()), at)]
    ddl = "table_name string, schema_hash string, schema_json string, changes string, checked_at string"
    return spark.createDataFrame(row, ddl).withColumn("checked_at", F.col("checked_at").cast("timestamp"))


_WIDER = ["tinyint", "smallint", "int", "bigint", "float", "double"]


_WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Precision and scale of a decimal or of a whole number; None for other types."""
    if isinstance(kind, T.DecimalType):
        return kind.precision, kind.scale
    whole = _WHOLE_DIGITS.get(kind.simpleString())
    return (whole, 0) if whole else None


def common_type(a: T.DataType, b: T.DataType, path: str = "") -> T.DataType:
    """The type that holds the values of both. Structs get the fields of both, the first one's in front; arrays
    and maps widen what they hold. Plain values that share no wider type become text. Nested values never become
    text: where one meets another kind, that is refused."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = [T.StructField(f.name, common_type(f.dataType, b[f.name].dataType, f"{path}.{f.name}") if f.name in b.names else f.dataType) for f in a.fields]
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in b.fields if f.name not in a.names])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType, f"{path}[]"))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType, f"{path}{{key}}"), common_type(a.valueType, b.valueType, f"{path}{{}}"))
    x, y = a.simpleString(), b.simpleString()
    if _nested(a) or _nested(b):
        raise SchemaDriftError(f"{path.strip('.')}: {x} and {y} cannot be merged")
    if x in _WIDER and y in _WIDER:
        # A 64-bit integer does not fit a float exactly; go to double.
        if {x, y} & {"bigint", "int"} and {x, y} & {"float"}:
            return T.DoubleType()
        return max(a, b, key=lambda t: _WIDER.index(t.simpleString()))
    digits = [_digits(t) for t in (a, b)]
    if None not in digits:
        scale = max(s for _, s in digits)
        precision = max(p - s for p, s in digits) + scale
        if precision > 38:
            raise ValueError(f"no decimal holds both {x} and {y}")
        return T.DecimalType(precision, scale)
    if {type(a), type(b)} & {T.DecimalType} and {x, y} & {"float", "double"}:
        return T.DoubleType()
    if {x, y} <= {"date", "timestamp", "timestamp_ntz"}:
        return T.TimestampType() if "timestamp" in (x, y) else T.TimestampNTZType()
    return T.StringType()


def _common_type(a: T.DataType, b: T.DataType) -> str:
    return common_type(a, b).simpleString()


def fitted(value: Column, kind: T.DataType, to: T.DataType) -> Column:
    """A value brought to a merged type: structs rebuilt by name, new fields null, null structs left null."""
    if kind.simpleString() == to.simpleString():
        return value
    if isinstance(to, T.StructType) and isinstance(kind, T.StructType):
        field = lambda f: fitted(value[f.name], kind[f.name].dataType, f.dataType) if f.name in kind.names else F.lit(None).cast(f.dataType)
        return F.when(value.isNotNull(), F.struct(*[field(f).alias(f.name) for f in to.fields]))
    if isinstance(to, T.ArrayType) and isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: fitted(x, kind.elementType, to.elementType))
    if isinstance(to, T.MapType) and isinstance(kind, T.MapType):
        entry = lambda e: F.struct(fitted(e["key"], kind.keyType, to.keyType).alias("key"), fitted(e["value"], kind.valueType, to.valueType).alias("value"))
        return F.map_from_entries(F.transform(F.map_entries(value), entry))
    return value.cast(to)


def evolve_union(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append with missing columns and nested fields filled by NULL and differing types widened to a common one."""
    old, new = existing.schema, incoming.schema
    both = [c for c in old.names if c in new.names]
    target = {c: common_type(old[c].dataType, new[c].dataType, c) for c in both}
    moved = lambda df: {c: fitted(F.col(c), df.schema[c].dataType, t) for c, t in target.items() if df.schema[c].dataType.simpleString() != t.simpleString()}
    fit = lambda df: df.withColumns(moved(df))
    return fit(existing).unionByName(fit(incoming), allowMissingColumns=True)
