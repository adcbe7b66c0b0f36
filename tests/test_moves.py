"""How often rows move, and how many tasks write them: what findings of larger tables asked for."""

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from cowrie.model import Dataset
from cowrie.operators import merge
from cowrie.plans.silver import refined
from cowrie.sources import files
from cowrie.sources.lake import FactTable, HalfWritten
from cowrie_checks.queries import write_by_country
from cowrie_checks.stream_queries import Replay
from cowrie_checks.views import VIEWS, holders_first, view


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return plan(df).count("Exchange hashpartitioning(")


@pytest.fixture
def shuffled(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


@pytest.mark.parametrize("apart", [None, False])
def test_where_many_keys_repeat_rows_move_once(spark, shuffled, tmp_path, apart):
    dataset = Dataset(name="x", key="k", columns="", event_column="day", amounts=("amount",))
    moment = F.timestamp_seconds(F.col("id") * 1000)
    spark.range(4000).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 900).alias("k"), (F.col("id") % 7 - 2).cast("double").alias("amount"),
        F.lit("XOF").alias("currency"), moment.alias("timestamp"), F.to_date(moment).alias("day"),
    ).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    one = refined(table, dataset, {}, apart=apart)
    assert exchanges(one) == 1
    assert as_set(one) == as_set(refined(table, dataset, {}, apart=True))


def test_lines_move_by_order_once(spark, shuffled, tmp_path):
    spark.range(40).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey"), F.lit("A").alias("c_mktsegment"),
        F.lit(1.0).alias("c_acctbal"),
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(80).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 45).alias("o_custkey"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(300).select(
        (F.col("id") % 90).alias("l_orderkey"), (F.col("id") % 4).cast("int").alias("l_linenumber"), (F.col("id") % 9).alias("l_partkey"),
        (F.col("id") % 5).alias("l_suppkey"), F.lit(1.0).alias("l_quantity"), F.lit(9.0).alias("l_extendedprice"),
        F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), F.timestamp_seconds(F.lit(0)).alias("l_shipdate"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    loans = view(spark, str(tmp_path), "v_loans")
    text = plan(loans)
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1
    assert text.count("Exchange hashpartitioning(o_custkey") == 1 and "l_extendedprice" not in "".join(
        line for line in text.splitlines() if "o_custkey" in line and "Exchange" in line)
    assert loans.count() == sum(1 for n in range(300) if n % 90 < 80 and (n % 90) % 45 < 40)
    assert all(holders_first(VIEWS[v]) != VIEWS[v] for v in ("v_loans", "v_insurance"))


def test_a_first_load_looks_for_no_keys(spark, tmp_path, monkeypatch):
    rows = spark.range(20).select("id", (F.col("id") % 3).cast("string").alias("part"))

    def refuse(*_):
        raise AssertionError("an empty table has no keys")

    for update, looked in ((False, "rows_to_insert"), (True, "rows_to_update")):
        table = FactTable(spark, f"{tmp_path}/{update}", "id", ["part"], update=update)
        with monkeypatch.context() as patched:
            patched.setattr(merge, looked, refuse)
            table.merge(rows)
            assert table.read().count() == 20
            with pytest.raises(AssertionError):
                table.merge(rows)
        table.recover()
        assert as_set(table.read()) == as_set(rows)


@pytest.mark.parametrize("update", [False, True])
def test_a_first_load_is_written_once_and_finished_by_the_next_job(spark, tmp_path, monkeypatch, update):
    rows = spark.range(20).select("id", (F.col("id") % 3).cast("string").alias("part"))
    table, moved = FactTable(spark, f"{tmp_path}/t", "id", ["part"], update=update), []
    exchange = files.exchange

    def dies(spark, folder, target):
        assert not files.exists(spark, f"{table.path}/_incoming")  # rows were staged there besides
        if moved:
            raise KeyboardInterrupt
        moved.append(target)
        exchange(spark, folder, target)

    with monkeypatch.context() as patched:
        patched.setattr(files, "exchange", dies)
        with pytest.raises(KeyboardInterrupt):
            table.merge(rows)
    assert len(moved) == 1
    with pytest.raises(HalfWritten):
        table.read()
    table.recover()
    assert as_set(table.read()) == as_set(rows)


def test_countries_are_written_from_one_reading(spark, tmp_path):
    rows = spark.range(12).select("id", F.when(F.col("id") < 9, F.concat(F.lit("C"), F.col("id") % 3)).alias("c"))
    assert write_by_country(spark, rows, "c", lambda c: f"{tmp_path}/{c}/x") == ["C0", "C1", "C2"]
    for n in range(3):
        got = spark.read.option("header", True).csv(f"{tmp_path}/C{n}/x")
        assert {(r["id"], r["c"]) for r in got.collect()} == {(str(i), f"C{n}") for i in range(9) if i % 3 == n}


def test_a_piece_has_as_many_files_as_its_micro_batch_takes(spark):
    replay = Replay(spark, "moves")
    for piece, n in ((0, 1000), (1, 3), (2, 0)):
        replay.send(spark.range(n).select(F.lit(None).cast("string").alias("key"), F.col("id").cast("string").alias("value")), "t", piece)
        names = files.children(spark, f"{replay.channel.folder('t')}/all/batch_id={piece}")
        assert sum(name.startswith("part-") for name in names) == replay.width > 1
    assert replay.channel.read(spark, "t").count() == 1003
