import datetime as dt

from pyspark.sql import functions as F

from meterloom.streaming import month_to_date as mtd

RECORDS = "meter_id bigint, ts timestamp, offpeak_kwh double, onpeak_kwh double"


def test_batches_add_up_and_replay_is_harmless(spark, tmp_path):
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    first = [(1, at(1, 1), 1.0, 2.0), (1, at(1, 5), 1.0, 0.0), (2, at(2, 3), 4.0, 1.0)]
    second = [(1, at(1, 9), 3.0, 1.0), (1, at(2, 1), 5.0, 5.0)]
    for rows in (first, second):
        spark.createDataFrame(rows, RECORDS).write.mode("append").parquet(source)
        mtd.run_daily_totals(spark.readStream.schema(RECORDS).parquet(source), out, mark)
    days = mtd.current_days(spark, out)
    got = sorted((r.meter_id, r.date.day, r.offpeak_kwh, r.onpeak_kwh) for r in days.collect())
    assert got == [(1, 1, 5.0, 3.0), (1, 2, 5.0, 5.0), (2, 2, 4.0, 1.0)]
    month = {r.meter_id: r for r in mtd.month_to_date(days).collect()}
    assert (month[1].days_elapsed, month[1].cum_offpeak_kwh, month[1].cum_onpeak_kwh) == (2, 10.0, 8.0)
    assert month[1].projected_bill > 0
    limits = spark.createDataFrame([(1, 0.0, 9.0)], "meter_id bigint, low double, high double")
    flags = {(r.meter_id, r.date.day): r.is_unusual for r in mtd.flag_unusual_days(days, limits).collect()}
    assert flags == {(1, 1): False, (1, 2): True, (2, 2): False}


def test_late_records_are_dropped(spark, tmp_path):
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    for rows in (
        [(1, dt.datetime(2024, 3, 1), 1.0, 1.0)],
        [(1, dt.datetime(2024, 3, 2), 1.0, 1.0)],
        [(1, dt.datetime(2024, 1, 1), 9.0, 9.0)],
    ):
        spark.createDataFrame(rows, RECORDS).write.mode("append").parquet(source)
        mtd.run_daily_totals(spark.readStream.schema(RECORDS).parquet(source), out, mark, late="10 days")
    assert {r.date for r in mtd.current_days(spark, out).collect()} == {dt.date(2024, 3, 1), dt.date(2024, 3, 2)}
    assert mtd.current_days(spark, out).agg(F.sum("total_kwh")).first()[0] == 4.0
