"""Loads that die at any write are carried on without loss or repetition."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from laminae import config
from laminae.operators import scd
from laminae.operators.control import Control
from laminae.operators.journal import Entry, Journal
from laminae.plans import medallion
from laminae.sinks import versions
from laminae.sources.tables import above_watermark

T0 = datetime(2024, 1, 1)
DDL = "k int, n timestamp, v string, op string"
KINDS = {
    "scd1": dict(strategy="cdc", sequence_by_column="n"),
    "scd2": dict(strategy="cdc", sequence_by_column="n", stored_as_scd_type=2),
    "keyed": dict(strategy="incremental", watermark_column="n"),
    "keyless": dict(strategy="incremental", watermark_column="n", primary_key=[]),
}


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


# The second delivery has a late event and a delete, the third brings a key back and repeats an event.
DELIVERIES = [
    [(1, at(1), "a", "c"), (2, at(2), "x", "c"), (3, at(3), "p", "c")],
    [(1, at(5), "b", "u"), (2, at(4), None, "d"), (1, at(3, 1), "late", "u"), (4, at(6), "n", "c")],
    [(2, at(7), "back", "c"), (3, at(8), "q", "u"), (1, at(5), "b", "u")],
]


class Died(Exception):
    pass


class Lake:
    def __init__(self, spark, folder, kind):
        load = {"strategy": "snapshot", "primary_key": ["k"], **KINDS[kind]}
        doc = {"target_name": "t", "source": "s", "source_schema": "x", "source_table": "t", "load": load}
        self.spark, self.folder, self.contract, self.kind = spark, folder, config.table_contract(doc), kind

    def deliver(self, upto, **settings):
        """Change logs bring one delivery; increments find all rows up to it in their source."""
        grows = self.contract.strategy == "incremental"
        rows = [r for d in DELIVERIES[:upto] for r in d] if grows else DELIVERIES[upto - 1]
        source = self.spark.createDataFrame(sorted(set(rows), key=rows.index) if grows else rows, DDL)

        def read(c, mark):
            return above_watermark(source, c.watermark_column, mark) if grows else source

        run = medallion.Run(self.spark, self.folder, read, T0 + timedelta(days=upto), **settings)
        medallion.bronze(run, self.contract)
        return run

    def rows(self):
        state = versions.read_version(self.spark, f"{self.folder}/bronze/t", self.journal().position().version)
        columns = [c for c in ("k", "n", "v", "_deleted", scd.START, scd.END) if c in state.columns]
        return sorted(map(str, state.select(*columns).collect()))

    def journal(self):
        return Journal(self.spark, f"{self.folder}/control/journal/t", f"{self.folder}/raw/t")


def dies(monkeypatch, point):
    """Lets the load of one delivery die right after (or in) one of its writes."""

    def after(owner, name):
        whole = getattr(owner, name)

        def broken(*args, **kw):
            whole(*args, **kw)
            raise Died(name)

        monkeypatch.setattr(owner, name, broken)

    if point == "in the raw batch":
        whole = Journal.land

        def cut(self, df):
            number = whole(self, df)
            versions.drop_folder(self.spark, f"{self.raw}/_batch_id={number}/_SUCCESS")
            raise Died(point)

        monkeypatch.setattr(Journal, "land", cut)
    elif point == "after the state":
        monkeypatch.setattr(Journal, "confirm", lambda self, entry: (_ for _ in ()).throw(Died(point)))
    else:
        after(*{"after the raw batch": (Journal, "land"), "after the plan": (Journal, "plan"), "after the confirmation": (Journal, "confirm")}[point])


@pytest.fixture(scope="module")
def undisturbed(spark, tmp_path_factory):
    """Rows and watermark after all deliveries, by kind."""
    found = {}
    for kind in KINDS:
        lake = Lake(spark, str(tmp_path_factory.mktemp(kind)), kind)
        for n in (1, 2, 3):
            lake.deliver(n)
        found[kind] = lake.rows(), lake.journal().position().watermark
    return found


def test_undisturbed_loads(undisturbed):
    rows, mark = undisturbed["keyless"]
    assert len(rows) == len({r for d in DELIVERIES for r in d}) and mark == "2024-01-08 00:00:00"
    assert [r.split("'")[1] for r in undisturbed["keyed"][0] if "'" in r] == ["b", "back", "q", "n"]
    assert len(undisturbed["scd2"][0]) == 8 and undisturbed["scd2"][1] is None


POINTS = ["after the raw batch", "after the state", "in the raw batch", "after the plan", "after the confirmation"]


@pytest.mark.parametrize(("kind", "point"), [(k, p) for k in KINDS for p in (POINTS if k in ("scd2", "keyless") else POINTS[:2])])
def test_a_crash_changes_nothing(spark, run_dir, undisturbed, kind, point):
    lake = Lake(spark, run_dir, kind)
    lake.deliver(1)
    with pytest.MonkeyPatch.context() as patched:
        dies(patched, point)
        with pytest.raises(Died):
            lake.deliver(2)
    if point == "in the raw batch":  # not accepted, so delivered again
        lake.deliver(2)
    lake.deliver(3)
    assert (lake.rows(), lake.journal().position().watermark) == undisturbed[kind]
    assert lake.journal().pending() == []


def test_a_run_that_dies_twice(spark, run_dir, undisturbed):
    lake = Lake(spark, run_dir, "keyless")
    lake.deliver(1)
    for point in ("after the state", "after the plan"):
        with pytest.MonkeyPatch.context() as patched:
            dies(patched, point)
            with pytest.raises(Died):
                lake.deliver(2)
    lake.deliver(3)
    assert (lake.rows(), lake.journal().position().watermark) == undisturbed["keyless"]


def test_deliveries_without_news_write_no_version(spark, run_dir):
    lake = Lake(spark, run_dir, "scd2")
    lake.deliver(1)
    again = lake.deliver(1)
    assert not again.steps[-1].changed and lake.journal().position().batch == 2
    increments = Lake(spark, f"{run_dir}/i", "keyed")
    increments.deliver(2)
    assert not increments.deliver(2).steps[-1].changed and increments.journal().batches() == [1]


def test_compacted_log_and_old_versions(spark, run_dir, undisturbed):
    lake = Lake(spark, run_dir, "scd2")
    for n in (1, 2, 3):
        lake.deliver(n, compact_after=1, keep_versions=1)
    journal = lake.journal()
    assert lake.rows() == undisturbed["scd2"][0]
    assert journal.batches("_upto=") == [2] and journal.batches() == [3]
    assert journal.log(3).count() == sum(map(len, DELIVERIES))
    assert versions.committed(spark, f"{run_dir}/bronze/t") == ["3"]


def test_log_of_batches_with_different_columns(spark, run_dir):
    journal = Journal(spark, f"{run_dir}/records", f"{run_dir}/raw")
    frames = [spark.createDataFrame([(1, 1)], "k int, a int"), spark.createDataFrame([(2, 2.5, "x")], "k int, a double, b string")]
    for df in frames:
        journal.apply(journal.land(df), None, 1, lambda number, batch, base: base + 1)
    assert sorted(map(tuple, journal.log(2).collect())) == [(1, 1.0, None), (2, 2.5, "x")]
    assert sorted(map(tuple, journal.log(1).collect())) == [(1, 1)]
    assert journal.position().version == 2 and journal.position().base == 1


def test_state_from_before_the_journal_is_taken_over(spark, run_dir):
    lake = Lake(spark, run_dir, "keyed")
    stamped = spark.createDataFrame(DELIVERIES[0], DDL).withColumn("_ingestion_timestamp", F.lit(T0).cast("timestamp"))
    versions.write_version(stamped, f"{run_dir}/bronze/t", 1)
    Control(spark, f"{run_dir}/control").set_watermark("t", "n", at(3), 3, T0)
    lake.deliver(2)
    assert len(lake.rows()) == 4 and lake.journal().position() == Entry(1, 4, 1, 2, "2024-01-06 00:00:00", lake.journal().position().schema)
