"""Bronze sources, layer hand-over through storage, metrics, partition layout,
incremental ingestion."""

import contextlib
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from settleframe.config import PipelineConfig
from settleframe.plans.bronze import accepted, ingest_instruments, quarantined
from settleframe.plans.medallion import run_medallion
from settleframe.sources.readers import read_table
from settleframe.sources.sinks import register_table, write_table
from settleframe.streaming import start_trades_stream

from settlement_rows import INSTRUMENT_ROWS, TRADE_ROWS


def _write_landing(root, extra_lines=()):
    trades_dir = root / "landing" / "trades"
    trades_dir.mkdir(parents=True)
    keys = ["TradeID", "InstrumentID", "Counterparty", "Notional", "Currency", "TradeDate", "SettlementDate", "Status"]
    lines = [json.dumps(dict(zip(keys, r))) for r in TRADE_ROWS] + list(extra_lines)
    (trades_dir / "part-1.json").write_text("\n".join(lines) + "\n")
    inst_dir = root / "landing" / "instruments"
    inst_dir.mkdir(parents=True)
    csv = ["instrument_id,InstrumentType,InstrumentName,Ticker,Exchange"]
    csv += [",".join(r) for r in INSTRUMENT_ROWS] + [",Equity,No Id,NOID,XX", "001,Bond,Short Row"]
    (inst_dir / "instruments.csv").write_text("\n".join(csv) + "\n")
    return {
        "delta_lake": {"bronze_path": str(root / "bronze") + "/", "silver_path": str(root / "silver") + "/",
                       "gold_path": str(root / "gold") + "/"},
        "source_to_target_mapping": {
            "trades": {"source_format": "json", "source_path": str(trades_dir), "bronze_table": "bronze_trades",
                       "silver_table": "silver_trades", "gold_table": "gold_trade_aggregates"},
            "instruments": {"source_format": "csv", "source_path": str(inst_dir),
                            "bronze_table": "bronze_instruments", "silver_table": "silver_instruments"},
        },
    }


def test_instruments_csv_keeps_text_ids(spark, tmp_path):
    cfg = _write_landing(tmp_path)
    df = ingest_instruments(spark, cfg["source_to_target_mapping"]["instruments"]["source_path"])
    assert "InstrumentID" in df.columns and "instrument_id" not in df.columns
    ok = {r.InstrumentID: r for r in accepted(df).collect()}
    assert "001" in ok  # not turned into the number 1
    assert ok["001"].Ticker is None and ok["001"].Exchange is None  # short row padded with nulls
    bad = quarantined(df).collect()
    assert len(bad) == 1 and bad[0].reject_reason == "null required field(s): InstrumentID"


def test_instrument_alias_conflict_is_refused(spark, tmp_path):
    d = tmp_path / "inst"
    d.mkdir()
    (d / "x.csv").write_text("InstrumentID,instrument_id\nA,B\n")
    with pytest.raises(ValueError):
        ingest_instruments(spark, str(d))


def test_full_run_through_storage(spark, tmp_path):
    cfg = _write_landing(tmp_path, extra_lines=["{bad json", '{"TradeID":"T7","Currency":"USD"}'])
    log = run_medallion(spark, cfg, batch_id="batch-1")
    m = {(r[0], r[1], r[2]): r[3] for r in log.rows}
    assert m[("bronze", "bronze_trades", "rows_read")] == 9
    assert m[("bronze", "bronze_trades", "rows_malformed")] == 1
    assert m[("bronze", "bronze_trades", "rows_missing_required")] == 1
    assert m[("bronze", "bronze_trades", "rows_accepted")] == 7
    assert m[("silver", "silver_trades", "invalid_currency")] == 1
    assert m[("silver", "silver_trades", "duplicates_removed")] == 1
    assert m[("silver", "silver_trades", "rows_written")] == 6
    assert m[("silver", "silver_instruments", "rows_written")] == 5
    assert m[("gold", "gold_trade_aggregates", "rows_written")] == 4
    assert m[("gold", "gold_counterparty_summary", "rows_written")] == 3

    cfgo = PipelineConfig.from_mapping(cfg)
    bronze = read_table(spark, cfgo.table_path("bronze", "bronze_trades"))
    assert {r.record_status for r in bronze.select("record_status").distinct().collect()} == {
        "ACCEPTED", "MALFORMED", "MISSING_REQUIRED"}
    assert bronze.filter(F.col("record_status") == "ACCEPTED").select("processing_batch_id").distinct().first()[0] \
        == "batch-1"
    gold_dir = cfgo.table_path("gold", "gold_trade_aggregates")
    assert sorted(os.listdir(os.path.join(gold_dir, "TradeYear=2024")))[:2] == ["TradeMonth=3", "TradeMonth=4"]
    gold = read_table(spark, gold_dir)
    assert gold.count() == 4
    summary = read_table(spark, cfgo.table_path("gold", "gold_counterparty_summary"))
    assert {r.Counterparty: r.NotionalRank for r in summary.collect()} == {"Ostrava Bank": 1, None: 2, "Harbour Trust": 3}
    metrics = read_table(spark, cfgo.table_path("gold", "pipeline_metrics"))
    assert metrics.count() == len(log.rows)
    from settleframe.plans.bronze import read_quarantine
    rejected = {r.record_status: r for r in read_quarantine(spark, cfgo, "bronze_trades").collect()}
    assert rejected["MALFORMED"]._corrupt_record == "{bad json"
    assert rejected["MISSING_REQUIRED"].reject_reason == "null required field(s): InstrumentID"


def test_partition_pruning_and_pushdown(spark, tmp_path, trades):
    from settleframe.plans.gold import trade_aggregates
    from settleframe.plans.silver import cleanse_trades

    silver_path = str(tmp_path / "silver")
    write_table(cleanse_trades(trades), silver_path)
    gold_path = str(tmp_path / "gold")
    write_table(trade_aggregates(read_table(spark, silver_path)), gold_path, partition_cols=["TradeYear", "TradeMonth"])
    pruned = read_table(spark, gold_path).filter((F.col("TradeYear") == 2024) & (F.col("TradeMonth") == 4))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(TradeYear" in plan
    silver_plan = trade_aggregates(read_table(spark, silver_path))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(data_quality_status), EqualTo(data_quality_status,CLEANSED)]" in silver_plan


def test_dedup_plan_limits_before_shuffle(trades):
    from settleframe.plans.silver import latest_trades

    plan = latest_trades(trades)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_register_table(spark, tmp_path, trades):
    path = str(tmp_path / "t")
    write_table(trades, path)
    register_table(spark, "settleframe_fixture_trades", path)
    assert spark.table("settleframe_fixture_trades").count() == 7
    spark.sql("DROP VIEW settleframe_fixture_trades")


def test_incremental_bronze_stream(spark, tmp_path):
    cfg = PipelineConfig.from_mapping(_write_landing(tmp_path))
    ckpt = str(tmp_path / "stream-ckpt")
    start_trades_stream(spark, cfg, ckpt, batch_id="stream-1").awaitTermination()
    table = cfg.table_path("bronze", "bronze_trades")
    assert read_table(spark, table).count() == 7
    # A new file arrives: only it is ingested on the next run.
    (tmp_path / "landing" / "trades" / "part-2.json").write_text(
        json.dumps({"TradeID": "T9", "InstrumentID": "XS-31", "Currency": "usd", "Notional": 1.0}) + "\n")
    start_trades_stream(spark, cfg, ckpt, batch_id="stream-2").awaitTermination()
    df = read_table(spark, table)
    assert df.count() == 8
    assert df.filter(F.col("TradeID") == "T9").select("processing_batch_id").first()[0] == "stream-2"


def test_bronze_write_parses_landing_once(spark, tmp_path):
    """Accepted and quarantined rows come from one scan of the landing files, with no shuffle."""
    from settleframe.plans.bronze import ingest_trades

    cfg = PipelineConfig.from_mapping(_write_landing(tmp_path, extra_lines=["{bad"]))
    df = ingest_trades(spark, cfg.trades.source_path, "json", batch_id="b")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1
    assert "Exchange" not in plan


def test_resume_from_stored_layer(spark, tmp_path):
    """A run resumed at silver reads the stored bronze table and gives the same gold."""
    cfg = _write_landing(tmp_path)
    run_medallion(spark, cfg, batch_id="b1", layers=("bronze",))
    log = run_medallion(spark, cfg, batch_id="b1", layers=("silver", "gold"))
    assert {r[0] for r in log.rows} == {"silver", "gold"}
    cfgo = PipelineConfig.from_mapping(cfg)
    gold = read_table(spark, cfgo.table_path("gold", "gold_trade_aggregates"))
    assert sorted((r.Counterparty or "-", r.DailyNotional) for r in gold.collect()) == [
        ("-", 40000.0), ("Harbour Trust", 1625.0), ("Ostrava Bank", -1000.0), ("Ostrava Bank", 3250000.125)]
    metrics = read_table(spark, cfgo.table_path("gold", "pipeline_metrics"))
    assert {r.layer for r in metrics.collect()} == {"bronze", "silver", "gold"}  # added to, not replaced
    assert {r.processing_batch_id for r in metrics.collect()} == {"b1"}
    with pytest.raises(ValueError):
        run_medallion(spark, cfg, batch_id="b1", layers=("platinum",))


def test_silver_reads_only_accepted_bronze_files(spark, tmp_path):
    from settleframe.plans.bronze import read_bronze

    cfg = _write_landing(tmp_path, extra_lines=["{bad"])
    run_medallion(spark, cfg, batch_id="b", layers=("bronze",))
    df = read_bronze(spark, PipelineConfig.from_mapping(cfg), "bronze_trades")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    scan = [line for line in out.getvalue().splitlines() if line.startswith("PartitionFilters")]
    assert scan and "record_status" in scan[0] and "ACCEPTED" in scan[0]
    assert df.count() == 7


def test_gold_reports_and_top_counterparties(spark, tmp_path):
    from settleframe.plans.gold import REPORT_TABLES, top_counterparties

    cfg = _write_landing(tmp_path)
    log = run_medallion(spark, cfg, batch_id="b", reports=True)
    m = {(r[1], r[2]): r[3] for r in log.rows if r[0] == "gold"}
    assert m[("gold_period_rollup", "rows_written")] == 9
    assert m[("gold_running_notional", "rows_written")] == 4
    assert m[("gold_trade_counts", "rows_written")] == 12  # 5 cells + 4 currency + 2 status subtotals + total
    cfgo = PipelineConfig.from_mapping(cfg)
    for name in REPORT_TABLES:
        assert read_table(spark, cfgo.table_path("gold", name)).count() == m[(name, "rows_written")]
    top = top_counterparties(spark, cfgo, 2).collect()
    assert sorted((r.NotionalRank, r.Counterparty) for r in top) == [(1, "Ostrava Bank"), (2, None)]


def test_register_partitioned_table_and_new_version(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("month"))
    path, name = str(tmp_path / "t"), "settleframe_fixture_months"
    write_table(df, path, partition_cols=["month"])
    register_table(spark, name, path)
    assert spark.table(name).count() == 100
    for months in (2, 1):   # the entry follows every overwrite
        write_table(df.filter(F.col("month") < months), path, partition_cols=["month"])
        assert {r.month for r in spark.table(name).select("month").distinct().collect()} == set(range(months))
        assert spark.read.parquet(path).count() == spark.table(name).count()   # any reader's path
    plan = spark.table(name).filter("month = 0")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    spark.sql(f"DROP VIEW {name}")


def test_overwrite_replaces_all_partitions_in_any_session_mode(spark, tmp_path):
    key = "spark.sql.sources.partitionOverwriteMode"
    before, path = spark.conf.get(key), str(tmp_path / "t")
    df = spark.range(30).select("id", (F.col("id") % 3).alias("month"))
    spark.conf.set(key, "dynamic")
    try:
        write_table(df, path, partition_cols=["month"])
        write_table(df.filter("month = 1"), path, partition_cols=["month"])
    finally:
        spark.conf.set(key, before)
    assert {r.month for r in read_table(spark, path).collect()} == {1}


def test_failed_write_leaves_the_table_in_place(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    broken = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_table(broken, path)
    assert read_table(spark, path).count() == 10 and os.listdir(tmp_path) == ["t"]


def test_nothing_is_left_beside_the_table_and_appends_stay(spark, tmp_path):
    path = tmp_path / "t"
    for n in (1, 2, 3, 4):
        write_table(spark.range(n), str(path))
    assert os.listdir(tmp_path) == ["t"]
    write_table(spark.range(5), str(path), mode="append")
    assert read_table(spark, str(path)).count() == 9


def test_a_table_can_be_written_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    write_table(read_table(spark, path).filter("id < 4").withColumn("twice", F.col("id") * 2), path)
    assert [tuple(r) for r in read_table(spark, path).orderBy("id").collect()] == [(i, 2 * i) for i in range(4)]


def test_empty_partitioned_table_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).select("id", (F.col("id") % 3).alias("month"))
    write_table(df, path, partition_cols=["month"])
    write_table(df.filter("id < 0"), path, partition_cols=["month"])
    assert spark.read.parquet(path).columns == ["id", "month"] and spark.read.parquet(path).count() == 0


def test_run_on_empty_landing(spark, tmp_path):
    cfg = _write_landing(tmp_path)
    for f in (tmp_path / "landing").rglob("*.*"):
        f.write_text("")
    log = run_medallion(spark, cfg, batch_id="empty", reports=True)
    assert {r[3] for r in log.rows} == {0}
    cfgo = PipelineConfig.from_mapping(cfg)
    gold = read_table(spark, cfgo.table_path("gold", "gold_trade_aggregates"))
    assert gold.count() == 0 and "DailyNotional" in gold.columns


def test_run_on_parquet_landing(spark, tmp_path, trades, instruments):
    cfg = _write_landing(tmp_path)
    for name, df in (("trades", trades.drop("ingestion_timestamp", "SettlementDate")), ("instruments", instruments.drop("Exchange"))):
        path = str(tmp_path / "parquet" / name)
        df.write.parquet(path)
        cfg["source_to_target_mapping"][name] |= {"source_format": "parquet", "source_path": path}
    log = run_medallion(spark, cfg, batch_id="p")
    m = {r[:3]: r[3] for r in log.rows}
    assert m["silver", "silver_trades", "rows_written"] == 6 and m["silver", "silver_instruments", "rows_written"] == 4
    assert m["bronze", "bronze_trades", "rows_with_type_errors"] == 0


def test_csv_columns_go_by_name_in_every_file(spark, tmp_path):
    from settleframe.plans.bronze import ingest_trades

    d = tmp_path / "csv"
    d.mkdir()
    (d / "a.csv").write_text("InstrumentID,TradeID,Currency,Notional\nI1,T1,usd,1.5\n")
    (d / "b.csv").write_text("TradeID,Currency,Extra,InstrumentID\nT2,eur,x,I2\n")
    rows = {r.TradeID: r for r in ingest_trades(spark, str(d), "csv", batch_id="b").collect()}
    assert (rows["T1"].InstrumentID, rows["T1"].Notional) == ("I1", 1.5)
    assert (rows["T2"].InstrumentID, rows["T2"].Currency, rows["T2"].Notional) == ("I2", "eur", None)
    i = tmp_path / "inst"
    i.mkdir()
    (i / "a.csv").write_text("instrument_id,InstrumentType\nA1,Bond\n")
    (i / "b.csv").write_text("InstrumentType,InstrumentID\nShare,B1\n")
    found = {(r.InstrumentID, r.InstrumentType) for r in accepted(ingest_instruments(spark, str(i))).collect()}
    assert found == {("A1", "Bond"), ("B1", "Share")}


def test_scratch_folders_can_be_cleaned(spark):
    from settleframe import session

    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    known = session._SCRATCH.pop(spark.sparkContext.applicationId)
    session._SCRATCH[spark.sparkContext.applicationId] = {path}   # only this one: others are still read
    assert session.clean_scratch(spark) == 1
    session._SCRATCH[spark.sparkContext.applicationId] = known - {path}
    assert not os.path.exists(path.removeprefix("file:"))


def test_trades_landing_as_csv(spark, tmp_path):
    from settleframe.plans.bronze import ingest_trades

    d = tmp_path / "csv"
    d.mkdir()
    (d / "t.csv").write_text(
        "TradeID,InstrumentID,Counterparty,Notional,Currency,TradeDate,SettlementDate,Status\n"
        "T1,I1,A,10.5,usd,2023-01-15 09:30:00,2023-01-17 09:30:00,SETTLED\n"
        "T2,I1,A,abc,EUR,2023-01-15 09:30:00,,PENDING\n"
        ",I2,B,1,USD,,,\n")
    rows = {r.TradeID: r for r in ingest_trades(spark, str(d), "csv", batch_id="b").collect()}
    assert rows["T1"].Notional == 10.5 and rows["T1"].record_status == "ACCEPTED"
    assert rows["T2"].Notional is None and rows["T2"].record_status == "ACCEPTED"
    assert rows[None].record_status == "MISSING_REQUIRED"


def test_instruments_inference_opt_in_and_fixed_stamp(spark, tmp_path):
    """inferSchema stays available (and shows why it is off: 001 becomes 1);
    a caller-supplied ingestion stamp replaces current_timestamp()."""
    import datetime as dt

    d = tmp_path / "numeric_ids"
    d.mkdir()
    (d / "i.csv").write_text("InstrumentID,InstrumentType\n001,Bond\n002,Equity\n")
    stamp = F.to_timestamp(F.lit("2024-06-30 18:00:00"))
    inferred = accepted(ingest_instruments(spark, str(d), infer_schema=True, ingested_at=stamp)).collect()
    assert sorted(r.InstrumentID for r in inferred) == ["1", "2"]
    assert {r.ingestion_timestamp for r in inferred} == {dt.datetime(2024, 6, 30, 18, 0)}
    as_text = accepted(ingest_instruments(spark, str(d))).collect()
    assert sorted(r.InstrumentID for r in as_text) == ["001", "002"]


def test_latest_copy_across_streamed_batches(spark, tmp_path):
    """Two landing batches carry the same trade; silver keeps the copy from the later batch."""
    from settleframe.plans.bronze import read_bronze
    from settleframe.plans.silver import cleanse_trades

    cfg = PipelineConfig.from_mapping(_write_landing(tmp_path))
    ckpt = str(tmp_path / "ckpt")
    start_trades_stream(spark, cfg, ckpt, batch_id="day-1").awaitTermination()
    correction = {"TradeID": "LN-9", "InstrumentID": "XS-12", "Counterparty": "Ostrava Bank", "Notional": 77.5,
                  "Currency": "EUR", "TradeDate": "2024-04-01 10:00:00", "Status": "SETTLED"}
    (tmp_path / "landing" / "trades" / "part-2.json").write_text(json.dumps(correction) + "\n")
    start_trades_stream(spark, cfg, ckpt, batch_id="day-2").awaitTermination()
    silver = {r.TradeID: r for r in cleanse_trades(read_bronze(spark, cfg, "bronze_trades")).collect()}
    assert len(silver) == 6
    assert (silver["LN-9"].Notional, silver["LN-9"].Status, silver["LN-9"].processing_batch_id) == (
        77.5, "SETTLED", "day-2")


def test_strict_quality_run_excludes_rejected_from_gold(spark, tmp_path):
    negative = {"TradeID": "T8", "InstrumentID": "XS-31", "Counterparty": "Harbour Trust", "Notional": -5.0,
                "Currency": "USD", "TradeDate": "2024-03-28 12:00:00", "Status": "SETTLED"}
    cfg = _write_landing(tmp_path, extra_lines=[json.dumps(negative)])
    cfg["strict_quality"] = True
    log = run_medallion(spark, cfg, batch_id="b")
    m = {(r[0], r[1], r[2]): r[3] for r in log.rows}
    assert m[("silver", "silver_trades", "rows_written")] == 7
    assert m[("silver", "silver_trades", "rows_rejected")] == 4  # no notional, no currency, two negative
    cfgo = PipelineConfig.from_mapping(cfg)
    silver = {r.TradeID: r for r in read_table(spark, cfgo.table_path("silver", "silver_trades")).collect()}
    assert silver["T8"].data_quality_status == "REJECTED" and silver["T8"].failed_rules == ["notional_min"]
    gold = {(r.Counterparty, str(r.TradeDateYYYYMMDD)): r.DailyNotional
            for r in read_table(spark, cfgo.table_path("gold", "gold_trade_aggregates")).collect()}
    assert gold[("Harbour Trust", "2024-03-28")] == 812.5  # neither T8 nor LN-12 counts


def test_max_records_per_file(spark, tmp_path):
    path = tmp_path / "capped"
    write_table(spark.range(1000).coalesce(1), str(path), max_records_per_file=300)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 4 and read_table(spark, str(path)).count() == 1000


def test_csv_files_that_begin_with_blank_lines(spark, tmp_path):
    from settleframe.sources.readers import read_instruments, read_trades

    d = tmp_path / "csv"
    d.mkdir()
    (d / "a.csv").write_text("\nTradeID,Currency\nT1,usd\n")
    (d / "b.csv").write_text("TradeID,Currency\nT2,eur\n")
    (d / "c.csv").write_text("Currency,TradeID\ngbp,T3\n")
    (d / "d.csv").write_text(" \t\r\n\nCurrency,InstrumentID,TradeID\nchf,I4,T4\n")
    (d / "e.csv").write_text("\n \n")
    got = {r.TradeID: r.Currency for r in read_trades(spark, str(d), "csv").collect()}
    assert got == {"T1": "usd", "T2": "eur", "T3": "gbp", "T4": "chf"}
    i = tmp_path / "all_blank_first"
    i.mkdir()
    (i / "a.csv").write_text("\nInstrumentID,InstrumentType\nA1,Bond\n")
    (i / "b.csv").write_text("\n\nInstrumentType,instrument_id\nShare,B1\n")
    assert {(r.InstrumentID, r.InstrumentType) for r in read_instruments(spark, str(i)).collect()} == {("A1", "Bond"), ("B1", "Share")}


def test_csv_headers_that_cannot_be_used_send_the_file_to_quarantine(spark, tmp_path):
    from settleframe.plans.bronze import ingest_trades

    d = tmp_path / "c s v"
    d.mkdir()
    (d / "a b.csv").write_text("\ufeffTradeID,InstrumentID,Currency\nT1,I1,usd\n", encoding="utf-8")
    (d / "quoted.csv").write_text('"TradeID","Desk, or book","InstrumentID",,"Currency"\nT2,x,I2,y,"eur"\n')
    (d / "twice.csv").write_text("TradeID,InstrumentID,TradeID,Currency\nT3,I3,T4,gbp\n")
    (d / "broken.csv").write_text('"Trade\nID",InstrumentID,Currency\nT5,I5,chf\n')
    rows = ingest_trades(spark, str(d), "csv", batch_id="b").collect()
    good = {r.TradeID: (r.InstrumentID, r.Currency) for r in rows if r.record_status == "ACCEPTED"}
    assert good == {"T1": ("I1", "usd"), "T2": ("I2", "eur")}
    bad = {(r._corrupt_record, r.reject_reason) for r in rows if r.record_status == "MALFORMED"}
    assert {b for b, _ in bad if "T3" in b or "T5" in b} == {"T3,I3,T4,gbp", "T5,I5,chf"}
    assert {p for _, p in bad} == {"header names TradeID twice", "header goes on behind a line break"} and len(bad) == 5
    (d / "a b.csv").write_text("InstrumentID,InstrumentID\nI1,I1\n")
    for f in ("quoted.csv", "broken.csv", "twice.csv"):
        (d / f).write_text("")
    found = ingest_instruments(spark, str(d)).collect()
    assert {(r.record_status, r.reject_reason) for r in found} == {("MALFORMED", "header names InstrumentID twice")} and len(found) == 2


def test_inference_goes_by_name(spark, tmp_path):
    from settleframe.sources.readers import read_instruments

    d = tmp_path / "csv"
    d.mkdir()
    (d / "a.csv").write_text("InstrumentID,Lot,Price,Live,Since,Big\n001,5,1.5,true,2024-01-02 03:04:05,9999999999\n")
    (d / "b.csv").write_text("Since,Live,InstrumentID,Price,Big,Lot\n2024-02-03 00:00:00,false,A1,2,1,7\n")
    df = read_instruments(spark, str(d), infer_schema=True)
    kinds = dict(df.dtypes)
    assert [kinds[c] for c in ("InstrumentID", "Lot", "Price", "Live", "Since", "Big")] == ["string", "int", "double", "boolean", "timestamp", "bigint"]
    assert {(r.InstrumentID, r.Lot, r.Price, r.Live) for r in df.collect()} == {("001", 5, 1.5, True), ("A1", 7, 2.0, False)}


def test_landing_without_a_required_column_is_refused(spark, tmp_path, trades):
    from settleframe.plans.bronze import ingest_trades

    trades.drop("TradeID").write.parquet(str(tmp_path / "p"))
    trades.drop("Currency").write.option("header", True).csv(str(tmp_path / "c"))
    for fmt, column in (("parquet", "TradeID"), ("csv", "Currency")):
        with pytest.raises(ValueError, match=column):
            ingest_trades(spark, str(tmp_path / fmt[0]), fmt)
    with pytest.raises(ValueError, match="identifier"):
        (tmp_path / "i.csv").write_text("Name\nx\n")
        ingest_instruments(spark, str(tmp_path / "i.csv"))
