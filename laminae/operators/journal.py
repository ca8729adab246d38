"""Write-ahead journal of one table's loads: raw batch, state version and watermark move together.

A delivery is first written as the raw batch N. A *planned* record then says what it will do: which
version it starts from, which it makes, and the watermark that it brings. After the state's version has
been written, a *confirmed* record with the same content puts all three in force at once; nothing is
read from a batch, version or watermark that is not confirmed. A run that dies leaves

* a raw batch without its end mark: the next delivery replaces it;
* a whole raw batch: the next run applies it from the confirmed version before it reads the source;
* a version not confirmed: applying the batch again replaces it.

Records are one-row folders numbered by batch. Looking for the newest one is a listing; only that one is
read, and old ones can be dropped.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from laminae.operators.drift import evolve_union
from laminae.sinks import versions

_RECORD = "batch bigint, rows bigint, base int, version int, watermark string, schema string"


@dataclass(frozen=True)
class Entry:
    """base: the state's version that the batch is applied to. version: the one that holds it (base, if it
    changed nothing)."""

    batch: int
    rows: int = 0
    base: int = 0
    version: int = 0
    watermark: str | None = None
    schema: str = ""


NOTHING = Entry(0)


class Journal:
    def __init__(self, spark: SparkSession, records: str, raw: str):
        self.spark, self.records, self.raw = spark, records.rstrip("/"), raw.rstrip("/")

    # ---- records ---------------------------------------------------------------------------------

    def _numbers(self, kind: str) -> list[int]:
        return sorted(int(v) for v in versions.committed(self.spark, self.records, f"{kind}="))

    def _read(self, kind: str, number: int) -> Entry:
        row = self.spark.read.schema(_RECORD).json(f"{self.records}/{kind}={number}").head()
        return Entry(**row.asDict())

    def _write(self, kind: str, entry: Entry) -> None:
        row = self.spark.createDataFrame([tuple(asdict(entry).values())], _RECORD)
        row.coalesce(1).write.mode("overwrite").json(f"{self.records}/{kind}={entry.batch}")

    def position(self) -> Entry:
        """The newest confirmed batch, with the version and watermark in force."""
        numbers = self._numbers("confirmed")
        return self._read("confirmed", numbers[-1]) if numbers else NOTHING

    def started(self) -> bool:
        return bool(self._numbers("planned") or self._numbers("confirmed"))

    def plan(self, entry: Entry) -> None:
        self._write("planned", entry)

    def confirm(self, entry: Entry) -> None:
        self._write("confirmed", entry)

    def prune(self, keep: int = 32) -> None:
        """Drop all but the newest confirmations; what was planned stays, as it holds the batches' schemas."""
        for number in self._numbers("confirmed")[:-keep]:
            versions.drop_folder(self.spark, f"{self.records}/confirmed={number}")

    # ---- raw batches -----------------------------------------------------------------------------

    def batches(self, prefix: str = "_batch_id=") -> list[int]:
        """Numbers of the raw batches that were written to their end."""
        return sorted(int(v) for v in versions.committed(self.spark, self.raw, prefix))

    def pending(self) -> list[int]:
        """Whole raw batches that are not confirmed, oldest first."""
        done = self.position().batch
        return [n for n in self.batches() if n > done]

    def land(self, df: DataFrame) -> int:
        """Write a delivery as the next raw batch."""
        number = max([self.position().batch, *self.batches()]) + 1
        df.write.mode("overwrite").parquet(f"{self.raw}/_batch_id={number}")
        return number

    def batch(self, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.raw}/_batch_id={number}")

    def log(self, upto: int) -> DataFrame:
        """All events of the batches up to a number, with the columns of all of them. Batches of one schema are
        one scan; schemas come from the journal, so no file is opened for them."""
        whole = [n for n in self.batches("_upto=") if n <= upto]
        start = whole[-1] if whole else 0
        later = [n for n in self.batches() if start < n <= upto]
        planned = set(self._numbers("planned"))
        groups: dict[str, list[str]] = {}
        for n in later:
            schema = self._read("planned", n).schema if n in planned else self.batch(n).schema.json()
            groups.setdefault(schema, []).append(f"{self.raw}/_batch_id={n}")
        frames = [self.spark.read.parquet(f"{self.raw}/_upto={start}")] if whole else []
        frames += [self.spark.read.schema(T.StructType.fromJson(json.loads(s))).parquet(*paths) for s, paths in groups.items()]
        found = frames[0]
        for frame in frames[1:]:
            found = evolve_union(found, frame)
        return found

    def compact(self, after: int) -> int | None:
        """Fold the confirmed batches into one folder once there are more than `after` of them since the last
        time. Readers take the folder from when it is whole; the batches it holds are dropped last."""
        done = self.position().batch
        whole = [n for n in self.batches("_upto=") if n <= done]
        if len([n for n in self.batches() if (whole[-1] if whole else 0) < n <= done]) <= after:
            return None
        self.log(done).write.mode("overwrite").parquet(f"{self.raw}/_upto={done}")
        for n in whole:
            versions.drop_folder(self.spark, f"{self.raw}/_upto={n}")
        for n in [n for n in self.batches() if n <= done]:
            versions.drop_folder(self.spark, f"{self.raw}/_batch_id={n}")
            versions.drop_folder(self.spark, f"{self.records}/planned={n}")
        return done

    # ---- loads -----------------------------------------------------------------------------------

    def apply(self, number: int, watermark: str | None, rows: int, write: Callable[[int, DataFrame, int], int]) -> Entry:
        """Bring the state up to a raw batch. `write(batch, rows of it, base version)` returns the version that
        holds the result; it must depend on nothing but the batch, the log up to it and the base version."""
        before, raw = self.position(), self.batch(number)
        kept = watermark if watermark is not None else before.watermark
        planned = Entry(number, rows, before.version, before.version + 1, kept, raw.schema.json())
        self.plan(planned)
        version = write(number, raw, before.version)
        done = Entry(number, rows, before.version, version, kept, planned.schema)
        self.confirm(done)
        return done
