"""Table contracts and environments, read from YAML."""

from __future__ import annotations

import os
import warnings
from dataclasses import dataclass, field
from pathlib import Path

import yaml

from laminae.operators.quality import Rule
from laminae.operators.scd import DELETE_VALUES

# Load strategies, and what the older `load.type` key means.
STRATEGIES = ["snapshot", "incremental", "cdc", "stream"]
LEGACY_TYPES = {"full": "snapshot", "incremental": "incremental", "stream": "stream"}
CHECKPOINT_TEMPLATE = "__CHECKPOINT_BASE__/bronze/{target_name}"
DEFAULT_TRIGGER = "60 seconds"
PACKAGED = Path(__file__).parent / "contracts"


class ContractError(ValueError):
    """A contract that cannot be honoured as written."""


@dataclass(frozen=True)
class StreamSettings:
    source_type: str
    trigger_interval: str
    checkpoint_location: str
    output_mode: str = "append"
    max_offsets_per_trigger: int | None = None


@dataclass(frozen=True)
class TableContract:
    target_name: str
    source: str
    database: str
    source_schema: str
    source_table: str
    strategy: str
    enabled: bool = True
    execution_order: int = 999
    primary_key: tuple[str, ...] = ()
    watermark_column: str | None = None
    sequence_by_column: str | None = None
    fetch_size: int = 10_000
    scd_type: int = 1
    on_duplicate: str = "error"
    operation_column: str = "op"
    delete_values: tuple[str, ...] = tuple(DELETE_VALUES)
    topic: str | None = None
    audit: dict = field(default_factory=dict)
    reconciliation: dict = field(default_factory=dict)
    drift: dict = field(default_factory=dict)
    rules: tuple[Rule, ...] = ()
    silver_mode: str = "batch"
    steps: tuple[dict, ...] = ()
    silver_scd_type: int = 1
    merge_keys: tuple[str, ...] = ()
    stream: StreamSettings | None = None

    @property
    def streaming(self) -> bool:
        return self.silver_mode == "streaming" or self.strategy in ("cdc", "stream")


@dataclass(frozen=True)
class Environment:
    name: str = "dev"
    checkpoint_base: str = ""
    quality_action: str | None = None
    trigger_interval: str | None = None


def strategy_of(load: dict) -> str:
    """The declared strategy; without one it follows from `load.type`. Unknown names are errors."""
    named = str(load.get("strategy") or "").strip().lower()
    if named:
        if named not in STRATEGIES:
            raise ContractError(f"unknown load strategy {named!r}")
        return named
    legacy = str(load.get("type") or "full").strip().lower()
    if legacy not in LEGACY_TYPES:
        raise ContractError(f"unknown load type {legacy!r}")
    if legacy == "stream" and (load.get("stream") or {}).get("source_type") == "cdc":
        return "cdc"
    return LEGACY_TYPES[legacy]


def _rules(raw: dict, env: Environment, table: str) -> tuple[Rule, ...]:
    """An environment may set one action for all rules; rules it changes are named in a warning."""
    rules = [Rule(r["name"], r["constraint"], r.get("action", "warn")) for r in raw.get("expectations", [])]
    if env.quality_action:
        changed = [r.name for r in rules if r.action != env.quality_action]
        if changed:
            warnings.warn(f"{table}: environment {env.name} sets {env.quality_action} for {changed}", stacklevel=2)
        rules = [Rule(r.name, r.constraint, env.quality_action) for r in rules]
    return tuple(rules)


def _stream(raw: dict, load: dict, strategy: str, env: Environment) -> StreamSettings | None:
    declared = load.get("stream")
    if declared is None and strategy not in ("cdc", "stream"):
        return None
    declared = declared or {}
    fallback = (load.get("cdc") or {}).get("source_type") or ("cdc" if strategy == "cdc" else "files")
    place = declared.get("checkpoint_location", CHECKPOINT_TEMPLATE)
    place = place.replace("__CHECKPOINT_BASE__", env.checkpoint_base).replace("{target_name}", raw["target_name"])
    return StreamSettings(
        source_type=declared.get("source_type", fallback),
        trigger_interval=env.trigger_interval or declared.get("trigger_interval", DEFAULT_TRIGGER),
        checkpoint_location=place,
        output_mode=declared.get("output_mode", "append"),
        max_offsets_per_trigger=declared.get("max_offsets_per_trigger"),
    )


def table_contract(raw: dict, env: Environment | None = None) -> TableContract:
    env = env or Environment()
    load, silver = raw.get("load") or {}, raw.get("silver") or {}
    cdc = load.get("cdc") or {}
    strategy = strategy_of(load)
    key = tuple(load.get("primary_key") or ())
    sequence = load.get("sequence_by_column") or load.get("watermark_column")
    return TableContract(
        target_name=raw["target_name"],
        source=raw["source"],
        database=raw.get("database", ""),
        source_schema=raw["source_schema"],
        source_table=raw["source_table"],
        strategy=strategy,
        enabled=raw.get("enabled", True),
        execution_order=int(raw.get("execution_order", 999)),
        primary_key=key,
        watermark_column=load.get("watermark_column"),
        sequence_by_column=sequence,
        fetch_size=int(load.get("fetch_size", 10_000)),
        scd_type=int(load.get("stored_as_scd_type", 1)),
        on_duplicate=load.get("on_duplicate", "error"),
        operation_column=cdc.get("operation_column", "op"),
        delete_values=tuple(cdc.get("delete_values", DELETE_VALUES)),
        topic=cdc.get("topic"),
        audit={"enabled": False, "retention_days": 90, "partition_by": None, **(load.get("snapshot_audit") or {})},
        reconciliation={"enabled": False, "schedule": "weekly", "method": "full_snapshot", **(load.get("reconciliation") or {})},
        drift={"mode": "auto_evolve", "alert_on_drift": True, "allowed_changes": ["add_column"], **(raw.get("schema_drift") or {})},
        rules=_rules(raw.get("quality") or {}, env, raw["target_name"]),
        silver_mode=silver.get("mode", "batch"),
        steps=tuple(silver.get("transformations") or ()),
        silver_scd_type=int(silver.get("scd_type", 1)),
        merge_keys=tuple(silver.get("merge_keys") or key),
        stream=_stream(raw, load, strategy, env),
    )


def _merged(base: dict, over: dict) -> dict:
    out = dict(base)
    for k, v in over.items():
        out[k] = _merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load_environment(name: str, path: str | os.PathLike = PACKAGED / "environments.yml") -> Environment:
    raw = yaml.safe_load(Path(path).read_text())[name]
    over = raw.get("overrides") or {}
    return Environment(name, raw.get("checkpoint_base", ""), over.get("default_quality_action"), over.get("streaming_trigger_interval"))


def load_contracts(path: str | os.PathLike = PACKAGED / "tables.yml", env: Environment | None = None) -> list[TableContract]:
    """Contracts of one file or of a folder tree (one `table:` per file, or a `tables:` list with
    shared `defaults:`), enabled ones only, by execution order and then by path."""
    root = Path(path)
    files = [root] if root.is_file() else sorted(p for p in root.rglob("*.yml") if not p.name.startswith("_"))
    found: list[TableContract] = []
    for file in files:
        doc = yaml.safe_load(file.read_text())
        entries = [doc["table"]] if "table" in doc else [_merged(doc.get("defaults") or {}, t) for t in doc.get("tables", [])]
        found += [table_contract(e, env) for e in entries]
    return sorted((c for c in found if c.enabled), key=lambda c: c.execution_order)
