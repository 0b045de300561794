"""Silver merged batch by batch against the rebuild from all batches."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from settleframe import catalog
from settleframe.plans import incremental
from settleframe.plans.incremental import IncrementalSilver
from settleframe.plans.silver import cleanse_trades
from settleframe.sources.files import exists

from settlement_rows import TRADES_DDL, at

SF = "/root/testdata/sf0.001"


def batch(spark, rows):
    return spark.createDataFrame(rows, TRADES_DDL)


def random_rows(rng, n):
    """Few ids, so that copies meet in every batch, with ties, nulls and moving dates."""
    day = lambda k: dt.datetime(2023, 11, 1) + dt.timedelta(days=k)
    return [(f"T{rng.randrange(40)}", f"I{rng.randrange(3)}", rng.choice(["A", "B", None]), rng.choice([1.5, 2.25, None, -7.0]),
             rng.choice(["usd", " EUR", "x"]), rng.choice([None, day(rng.randrange(150))]), None, "SETTLED",
             rng.choice([None, day(rng.randrange(4))])) for _ in range(n)]


def rows_of(df):
    return sorted(map(str, df.drop("silver_processing_timestamp", incremental.MONTH).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_equal_the_rebuild(spark, tmp_path, seed):
    rng = random.Random(seed)
    batches = [random_rows(rng, 60) for _ in range(3)]
    want = rows_of(cleanse_trades(batch(spark, sum(batches, []))))
    rng.shuffle(batches)
    table = IncrementalSilver(spark, f"silver_random_{seed}", str(tmp_path / "silver"), buckets=4)
    for rows in [*batches, batches[0]]:     # the first once more: changes nothing
        table.merge(batch(spark, rows))
    assert rows_of(table.read()) == want
    again = IncrementalSilver(spark, f"silver_again_{seed}", table.path, buckets=4)    # as another session does
    again.attach()
    assert rows_of(again.read()) == want
    stored = table.read()
    assert {r[0] for r in stored.select(incremental.MONTH).distinct().collect()} == {
        r[0] for r in stored.select(F.coalesce(F.date_format("TradeDate", "yyyy-MM"), F.lit("none"))).distinct().collect()}


def test_months_that_a_batch_does_not_touch_keep_their_files(spark, tmp_path):
    table = IncrementalSilver(spark, "silver_months", str(tmp_path / "silver"), buckets=4)
    stamp, later = at("2024-01-01 00:00:00"), at("2024-02-01 00:00:00")
    row = lambda i, date, s, amount=1.0: (i, "I1", "A", amount, "USD", at(date), None, "SETTLED", s)
    first = table.merge(batch(spark, [row("a", "2023-01-05 00:00:00", stamp), row("b", "2023-02-05 00:00:00", stamp),
                                      row("c", "2023-02-06 00:00:00", stamp), row("d", "2023-04-01 00:00:00", stamp)]))
    assert first == incremental.MergeResult(4, 0, 0, ("2023-01", "2023-02", "2023-04"))
    files = lambda m: {p.name for p in (tmp_path / "silver/4_buckets" / f"trade_month={m}").glob("*.parquet")}
    untouched, january = files("2023-02"), files("2023-01")
    # a moves to March, so January is empty then; an old copy of b changes nothing.
    second = table.merge(batch(spark, [row("a", "2023-03-05 00:00:00", later), row("b", "2023-05-01 00:00:00", at("2023-12-31 00:00:00"))]))
    assert second == incremental.MergeResult(2, 1, 1, ("2023-01", "2023-03"))
    assert january and files("2023-02") == untouched and not files("2023-01")
    assert sorted((r.TradeID, r.trade_month) for r in table.read().collect()) == [
        ("a", "2023-03"), ("b", "2023-02"), ("c", "2023-02"), ("d", "2023-04")]
    # Plain readers of the folder see the same rows, and no scratch is left.
    assert spark.read.parquet(table.location).count() == 4
    assert not exists(spark, f"{table.path}/_batch") and not exists(spark, f"{table.path}/_met")


def test_empty_batches(spark, tmp_path):
    table = IncrementalSilver(spark, "silver_empty", str(tmp_path / "silver"), buckets=4)
    none = batch(spark, [])
    assert table.merge(none) == incremental.MergeResult(0, 0, 0, ())
    assert table.read().count() == 0
    one = [("a", "I1", None, None, None, None, None, None, None)]
    assert table.merge(batch(spark, one)).months == ("none",)
    assert table.merge(none).months == ()
    assert [r.TradeID for r in table.read().collect()] == ["a"]


def test_a_run_that_failed_half_way_is_finished_by_running_it_again(spark, tmp_path, monkeypatch):
    table = IncrementalSilver(spark, "silver_failed", str(tmp_path / "silver"), buckets=4)
    row = lambda date, s: ("a", "I1", "A", 1.0, "USD", at(date), None, "SETTLED", at(s))
    table.merge(batch(spark, [row("2023-01-05 00:00:00", "2024-01-01 00:00:00")]))
    move = batch(spark, [row("2023-03-05 00:00:00", "2024-02-01 00:00:00")])
    real, calls = incremental.delete, []

    def fails(spark_, path):
        calls.append(path)
        if "trade_month=" in path:
            raise OSError("lost")
        real(spark_, path)

    monkeypatch.setattr(incremental, "delete", fails)
    with pytest.raises(OSError):
        table.merge(move)
    monkeypatch.setattr(incremental, "delete", real)
    table.merge(move)
    assert [(r.TradeID, r.trade_month) for r in table.read().collect()] == [("a", "2023-03")]


def test_the_stored_table_is_not_shuffled(spark, tmp_path):
    """One exchange, of the batch; the stored side is scanned by buckets, ids and stamps only."""
    table = IncrementalSilver(spark, "silver_plan", str(tmp_path / "silver"), buckets=4)
    rows = random_rows(random.Random(3), 80)
    table.merge(batch(spark, rows))
    stored = table.read()
    new = spark.createDataFrame(stored.limit(5).collect(), stored.schema)
    months = [r[0] for r in stored.select(incremental.MONTH).distinct().collect()]
    for df in (incremental.meetings(stored, new, 4), incremental.replaced_months(stored, new, months[:1], 4)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        stored_side = plan[:plan.index("FileScan")].rsplit("Join", 1)[1]
        assert "Exchange" not in stored_side and re.search(r"Bucketed: true", plan)
    read = re.search(r"FileScan parquet \S*?\[(.*?)\]", incremental.meetings(stored, new, 4)._jdf.queryExecution().executedPlan().toString())
    assert "TradeID" in read[1] and "silver_processing_timestamp" not in read[1] and "data_quality_status" not in read[1]


def test_buckets_grow_with_the_trades(spark, monkeypatch):
    """A merge has one task a bucket, so their number follows the rows."""
    assert [incremental.buckets_for(n) for n in (0, 600_000, 36_000_000, 216_000_000)] == [2, 2, 24, 144]
    monkeypatch.setattr(incremental, "BUCKET_ROWS", 1000)
    trades = catalog._bronze(spark, SF)
    merged = catalog.q_silver_merged_batches(spark, SF)
    assert all(f"/{-(-trades.count() // 1000)}_buckets/" in f for f in merged.inputFiles())
    assert trades.count() > 2000 and merged.count() == trades.select("TradeID").distinct().count()
