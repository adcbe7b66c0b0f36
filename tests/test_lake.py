"""Merges and tables, also when a job died half way."""

import os
import random

import pytest
from conftest import as_set, day
from pyspark.sql import functions as F

from cowrie.operators import merge
from cowrie.operators.incremental import first_pending, pending_periods
from cowrie.sources import files
from cowrie.sources.lake import DuplicateMatch, FactTable, HalfWritten, Lake, PeriodTable, SmallTable, WrongShape

DDL = "k string, v int, place string"


@pytest.fixture
def table(spark, tmp_path):
    return FactTable(spark, str(tmp_path / "t"), "k", ["place"], update=True)


@pytest.fixture
def insert_only(spark, tmp_path):
    return FactTable(spark, str(tmp_path / "i"), "k", ["place"])


def test_insert_only_merge(insert_only, rows):
    insert_only.merge(rows(DDL, ("a", 1, "x"), (None, 2, "x")))
    insert_only.merge(rows(DDL, ("a", 9, "y"), ("b", 3, "x"), ("b", 4, "x"), (None, 5, "x")))
    # known key ignored, duplicates inside the source kept, NULL keys always inserted
    assert as_set(insert_only.read()) == {("a", 1, "x"), (None, 2, "x"), ("b", 3, "x"), ("b", 4, "x"), (None, 5, "x")}


def test_upsert_moves_rows_and_empties_partitions(table, rows, spark):
    table.merge(rows(DDL, ("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z"), ("d", 4, None)))
    table.merge(rows(DDL, ("a", 10, "y"), ("d", 40, "z"), ("e", 5, "w"), ("f", 6, None)))
    assert as_set(table.read()) == {("a", 10, "y"), ("b", 2, "y"), ("c", 3, "z"), ("d", 40, "z"), ("e", 5, "w"), ("f", 6, None)}
    assert not os.path.exists(f"{table.path}/place=x")


def test_upsert_leaves_untouched_partitions_alone(table, rows):
    table.merge(rows(DDL, ("a", 1, "x"), ("b", 2, "y")))
    before = sorted(os.listdir(f"{table.path}/place=y"))
    table.merge(rows(DDL, ("a", 2, "x"), ("c", 3, "w")))
    assert sorted(os.listdir(f"{table.path}/place=y")) == before


def test_upsert_is_last_writer_wins(table, rows):
    rng, state = random.Random(5), {}
    for _ in range(4):
        batch = {f"k{rng.randrange(40)}": (rng.randrange(100), rng.choice("xyz")) for _ in range(25)}
        table.merge(rows(DDL, *[(k, v, p) for k, (v, p) in batch.items()]))
        state |= batch
    assert as_set(table.read()) == {(k, v, p) for k, (v, p) in state.items()}


def test_same_input_twice_changes_nothing(table, insert_only, rows):
    batch = rows(DDL, ("a", 1, "x"), ("b", 2, "y"))
    for t in (table, insert_only):
        t.merge(batch)
        t.merge(batch)
        assert as_set(t.read()) == {("a", 1, "x"), ("b", 2, "y")}


def test_ambiguous_update_is_an_error_but_ambiguous_insert_is_not(table, rows):
    table.merge(rows(DDL, ("a", 1, "x")))
    table.merge(rows(DDL, ("b", 1, "x"), ("b", 2, "x")))
    assert table.read().count() == 3
    with pytest.raises(DuplicateMatch):
        table.merge(rows(DDL, ("a", 2, "x"), ("a", 3, "y")))


def test_a_refused_merge_does_not_block_the_next(table, rows):
    table.merge(rows(DDL, ("a", 1, "x")))
    with pytest.raises(DuplicateMatch):
        table.merge(rows(DDL, ("a", 2, "x"), ("a", 3, "y")))
    table.merge(rows(DDL, ("a", 5, "x")))
    assert as_set(table.read()) == {("a", 5, "x")}


@pytest.mark.parametrize("step", ["_write", "_put_rewritten", "_partitioned"])
def test_a_job_that_dies_is_finished_by_the_next(table, rows, monkeypatch, step):
    table.merge(rows(DDL, ("a", 1, "x"), ("b", 2, "x"), ("c", 3, "y")))
    batch = rows(DDL, ("a", 10, "y"), ("n", 7, "w"))

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(table, step, die)
        with pytest.raises(RuntimeError):
            table.merge(batch)
    table.recover()
    assert as_set(table.read()) == {("a", 10, "y"), ("b", 2, "x"), ("c", 3, "y"), ("n", 7, "w")}
    assert not os.path.exists(f"{table.path}/_incoming")


def test_a_job_that_dies_between_the_partitions(table, rows, spark):
    """The rewritten partitions are complete, but the table has lost one of them."""
    table.merge(rows(DDL, ("a", 1, "x"), ("b", 2, "x"), ("c", 3, "y")))
    batch = rows(DDL, ("a", 10, "x"), ("c", 30, "y"))
    batch.write.parquet(f"{table.path}/_incoming")
    kept = rows(DDL, ("a", 10, "x"), ("b", 2, "x"), ("c", 30, "y"))
    kept.write.partitionBy("place").parquet(f"{table.path}/_rewrite")
    files.remove(spark, f"{table.path}/place=x")
    table.recover()
    assert as_set(table.read()) == {("a", 10, "x"), ("b", 2, "x"), ("c", 30, "y")}


def test_rows_of_a_folder_that_was_being_exchanged_are_not_lost(table, rows, spark, monkeypatch):
    """The job dies after the old folder has gone and before the new one is in its place."""
    table.merge(rows(DDL, ("a", 1, "x"), ("b", 2, "x"), ("c", 3, "y")))

    def half(spark, folder, target):
        files.remove(spark, target)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(files, "exchange", half)
        with pytest.raises(RuntimeError):
            table.merge(rows(DDL, ("a", 10, "x"), ("n", 7, "w")))
    table.recover()
    assert as_set(table.read()) == {("a", 10, "x"), ("b", 2, "x"), ("c", 3, "y"), ("n", 7, "w")}


def test_create_is_tolerant_and_keeps_the_first_schema(table, rows):
    assert not table.exists()
    table.create(DDL)
    table.create("other int")
    assert table.exists() and table.read().columns == ["k", "v", "place"]
    assert table.read().isEmpty()


def test_replace_partitions(table, rows):
    table.append(rows(DDL, ("a", 1, "x"), ("b", 2, "x"), ("c", 3, "y")))
    table.replace_partitions(rows(DDL, ("d", 4, "x")))
    assert as_set(table.read()) == {("d", 4, "x"), ("c", 3, "y")}


def test_snapshots(spark, rows, tmp_path):
    small = SmallTable(spark, str(tmp_path / "s"))
    assert not small.exists()
    for n in range(3):
        small.write(rows("g string, v int", ("a", n)))
        assert as_set(small.read()) == {("a", n)}
    # a write that did not finish is not read
    os.makedirs(tmp_path / "s" / "v00000009")
    assert small.read().count() == 1
    assert sorted(os.listdir(tmp_path / "s")) == ["v00000002", "v00000003", "v00000009"]


GOLD = "period date, g string, v int"


def contents(path):
    return {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet") if "_schema" not in str(f)}


def test_an_upsert_of_one_day_leaves_other_months_alone(spark, rows, tmp_path):
    table = PeriodTable(spark, str(tmp_path / "g"))
    assert not table.exists() and table.latest() is None
    assert table.upsert(rows(
        GOLD, (day("2026-01-01"), "a", 1), (day("2026-01-01"), None, 2), (day("2026-01-31"), "a", 3), (day("2026-02-03"), "a", 4)
    ), ["period", "g"]) == 4
    before = contents(tmp_path / "g")
    assert table.upsert(rows(GOLD, (day("2026-02-03"), "a", 5), (day("2026-02-04"), "b", 6)), ["period", "g"]) == 2
    after = contents(tmp_path / "g")
    assert {f for f in after if "month=2026-01-01" in str(f)} == {f for f in before if after.get(f) == before[f]}
    assert table.latest() == day("2026-02-04")
    assert table.upsert(rows(GOLD, (day("2026-01-01"), "a", 9), (day("2026-01-01"), None, 7)), ["period", "g"]) == 2
    assert as_set(table.read()) == {
        (day("2026-01-01"), "a", 9), (day("2026-01-01"), None, 2), (day("2026-01-01"), None, 7),
        (day("2026-01-31"), "a", 3), (day("2026-02-03"), "a", 5), (day("2026-02-04"), "b", 6),
    }
    with pytest.raises(DuplicateMatch):
        table.upsert(rows(GOLD, (day("2026-02-04"), "b", 1), (day("2026-02-04"), "b", 2)), ["period", "g"])
    with pytest.raises(WrongShape):
        table.upsert(rows(GOLD, (None, "b", 1)), ["period", "g"])
    with pytest.raises(ValueError):
        table.upsert(rows(GOLD, (day("2026-02-04"), "b", 1)), ["g"])
    assert table.upsert(rows(GOLD), ["period", "g"]) == 0 and table.read().count() == 6


def test_an_upsert_that_died_between_its_months(spark, rows, tmp_path, monkeypatch):
    table = PeriodTable(spark, str(tmp_path / "g"))
    table.upsert(rows(GOLD, (day("2026-01-01"), "a", 1), (day("2026-02-01"), "a", 2), (day("2026-03-01"), "a", 3)), ["period", "g"])
    real, moved = files.exchange, []

    def once(*args):
        if moved:
            raise RuntimeError("driver lost")
        moved.append(args)
        real(*args)

    with monkeypatch.context() as patched:
        patched.setattr(files, "exchange", once)
        with pytest.raises(RuntimeError):
            table.upsert(rows(GOLD, (day("2026-01-01"), "a", 10), (day("2026-02-01"), "b", 20)), ["period", "g"])
    with pytest.raises(HalfWritten):
        table.read()
    table.recover()
    assert as_set(table.read()) == {
        (day("2026-01-01"), "a", 10), (day("2026-02-01"), "a", 2), (day("2026-02-01"), "b", 20), (day("2026-03-01"), "a", 3)
    }


def test_null_keys_when_merging_aggregates(rows):
    target = rows("p int, g string, v int", (1, None, 1), (1, "a", 1))
    source = rows("p int, g string, v int", (1, None, 2))
    assert merge.upserted(target, source, ["p", "g"]).count() == 3
    assert as_set(merge.upserted(target, source, ["p", "g"], null_safe=True)) == {(1, "a", 1), (1, None, 2)}


def test_replaced_period(rows):
    target = rows("p int, v int", (1, 1), (2, 2), (None, 3))
    assert as_set(merge.replaced(target, rows("p int, v int", (1, 9)), "p", 1)) == {(2, 2), (None, 3), (1, 9)}


def test_high_water_mark_is_strict_unless_told(rows):
    df = rows("d date", (day("2026-01-01"),), (day("2026-01-05"),), (day("2026-02-03"),), (None,))
    assert [r[0] for r in pending_periods(df, "d", "day", day("2026-01-05")).collect()] == [day("2026-02-03")]
    # a late day, or a new day inside a known month, stays out …
    assert [r[0] for r in pending_periods(df, "d", "month", day("2026-01-01")).collect()] == [day("2026-02-01")]
    # … unless the current period is to be computed anew
    again = pending_periods(df, "d", "month", day("2026-01-01"), refresh_current=True)
    assert [r[0] for r in again.collect()] == [day("2026-01-01"), day("2026-02-01")]
    assert first_pending(None, "day") is None


def test_tables_are_placed_by_layer(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.bronze("bank_transactions").partition_by == ["country_code", "event_date"]
    assert lake.bronze("products").partition_by == []
    assert lake.silver("mobile_money").update and not lake.bronze("mobile_money").update
    assert lake.report().read().isEmpty()


def test_days_come_from_folders_or_from_rows(spark, tmp_path, rows):
    ddl = "k string, country_code string, event_date date"
    batch = rows(
        ddl, ("a", "CI", day("2026-01-02")), ("b", "GH", day("2026-01-01")), ("c", "GH", None), ("d", None, day("2026-01-05"))
    )
    for number, places in enumerate((["country_code", "event_date"], ["country_code"], [])):
        table = FactTable(spark, str(tmp_path / str(number)), "k", places)
        assert table.days("event_date") == [] and table.latest("event_date") is None
        table.append(batch)
        assert table.days("event_date") == [day("2026-01-01"), day("2026-01-02"), day("2026-01-05")]
        assert table.latest("event_date") == day("2026-01-05")

        def keys(*bounds):
            return {r["k"] for r in table.read_days("event_date", *bounds).collect()}

        assert keys() == {"a", "b", "d"}
        assert keys(day("2026-01-02")) == {"a", "d"}
        assert keys(day("2026-01-01"), day("2026-01-02")) == {"a", "b"}
        assert keys(day("2026-02-01")) == set()
        read = table.read_days("event_date", day("2026-01-01"), day("2026-01-01"))
        assert as_set(read) == {("b", "GH", day("2026-01-01"))}


def test_a_half_written_table_is_not_read(table, rows, monkeypatch):
    table.merge(rows(DDL, ("a", 1, "x")))
    with monkeypatch.context() as patched:
        patched.setattr(table, "_update_and_insert", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge(rows(DDL, ("a", 2, "x"), ("b", 3, "y")))
    for read in (table.read, lambda: table.read_days("place"), lambda: table.days("place")):
        with pytest.raises(HalfWritten):
            read()
    table.recover()
    assert as_set(table.read()) == {("a", 2, "x"), ("b", 3, "y")}


@pytest.mark.parametrize("ddl,row", [
    ("k string, place string", ("a", "x")),
    (f"{DDL}, more int", ("a", 2, "x", 3)),
    ("k string, v string, place string", ("a", "2", "x")),
])
def test_rows_of_another_shape_are_refused(table, insert_only, rows, ddl, row):
    for t in (table, insert_only):
        t.merge(rows(DDL, ("a", 1, "x")))
        for write in (t.merge, t.append, t.replace_partitions):
            with pytest.raises(WrongShape):
                write(rows(ddl, row))
        assert as_set(t.read()) == {("a", 1, "x")}
        t.merge(rows("place string, v int, k string", ("x", 5, "z")))  # the order of columns doesn't matter
        assert as_set(t.read()) == {("a", 1, "x"), ("z", 5, "x")}


def test_a_row_moves_out_of_a_partition_with_an_odd_name(table, rows):
    for name in ("x:y", "50% off/now", "a=b", "é ü"):
        table.merge(rows(DDL, ("a", 1, name), ("keep", 0, "q")))
        table.merge(rows(DDL, ("a", 2, "z")))
        assert as_set(table.read()) == {("a", 2, "z"), ("keep", 0, "q")}


def test_an_interrupted_creation_is_completed(table, rows):
    os.makedirs(f"{table.path}/_schema")
    table.merge(rows(DDL, ("a", 1, "x")))
    assert as_set(table.read()) == {("a", 1, "x")}


def test_an_upsert_rewrites_only_the_folders_of_its_rows(table, rows):
    table.merge(rows(DDL, ("a", 1, "a"), ("b", 2, "m"), ("c", 3, "z")))
    middle = sorted(os.listdir(f"{table.path}/place=m"))
    table.merge(rows(DDL, ("a", 10, "a"), ("c", 30, "z")))
    assert sorted(os.listdir(f"{table.path}/place=m")) == middle  # though its name lies between the others
    assert as_set(table.read()) == {("a", 10, "a"), ("b", 2, "m"), ("c", 30, "z")}


def test_aggregates_refuse_ambiguous_updates_and_other_shapes(spark, rows, tmp_path):
    table, keys, may = PeriodTable(spark, str(tmp_path / "s")), ["period", "g"], day("2026-05-01")
    table.upsert(rows(GOLD, (may, None, 1), (may, "a", 2)), keys, null_safe=True)
    table.upsert(rows(GOLD, (may, None, 5)), keys, null_safe=True)
    with pytest.raises(DuplicateMatch):
        table.upsert(rows(GOLD, (may, None, 3), (may, None, 4)), keys, null_safe=True)
    with pytest.raises(WrongShape):
        table.upsert(rows("period date, g string", (may, "a")), keys)
    assert as_set(table.read()) == {(may, None, 5), (may, "a", 2)}


def test_unpartitioned_tables_only_grow(spark, tmp_path):
    with pytest.raises(ValueError):
        FactTable(spark, str(tmp_path / "u"), "k", [], update=True)
