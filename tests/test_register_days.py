import datetime as dt
import random

from pyspark.sql import functions as F

from meterloom.operators import series
from meterloom.streaming import register_days as rd

RECORDS = "meter_id bigint, ts timestamp, reg_offpeak double, reg_peak double, reg_shoulder double"


def batch_days(rows):
    readings = rows.withColumn("read_date", F.to_date("ts")).drop("ts")
    return series.daily_consumption(series.fill_readings(series.dedupe_readings(readings, "max")))


def listed(days):
    return sorted((r.meter_id is not None, r.meter_id, r.date, r.offpeak_kwh, r.onpeak_kwh, r.total_kwh) for r in days.collect())


def test_unordered_files_give_the_days_of_the_batch_chain(spark, tmp_path):
    """Three runs over files whose records are shuffled within ten days; registers fall, repeat and are missing."""
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    rng, rows = random.Random(3), []
    for meter in (1, 2, 3, 4):
        register = [0.0, 0.0, 0.0]
        for day in range(0, 90, 1 if meter < 3 else 4):
            for _ in range(rng.choice((1, 1, 3))):
                register = [0.0] * 3 if rng.random() < 0.03 else [x + rng.randrange(9) for x in register]
                shown = [None if rng.random() < 0.05 else x for x in register]
                at = dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=rng.randrange(24))
                rows.append((meter, at, *shown))
    rows = [r for r in rows if r[0] != 4 or r[1] < dt.datetime(2024, 1, 20)]  # one meter falls silent
    rows.sort(key=lambda r: r[1].timestamp() + rng.random() * 10 * 86400)
    for at in (0, 1, 2):
        part = rows[at * len(rows) // 3 : (at + 1) * len(rows) // 3]
        for piece in (part[: len(part) // 2], part[len(part) // 2 :]):
            spark.createDataFrame(piece, RECORDS).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(RECORDS).option("maxFilesPerTrigger", 1).parquet(source)
        rd.run_register_days(stream, out, mark, late="12 days")
        seen = spark.createDataFrame(rows[: (at + 1) * len(rows) // 3], RECORDS)
        assert listed(rd.current_days(spark, out)) == listed(batch_days(seen))
    closed = spark.read.parquet(f"{out}/closed")
    assert closed.groupBy("meter_id", "date").count().where("count > 1").count() == 0  # written once
    newest = spark.read.parquet(f"{out}/open/*").agg(F.max("batch")).first()[0]
    left = spark.read.parquet(f"{out}/open/{newest % 2}").where("date IS NOT NULL")
    assert closed.count() > 100 and left.agg(F.min("date")).first()[0] > dt.date(2024, 2, 20)  # the snapshot does not grow
    assert left.where("meter_id = 4").count() == 0  # a silent meter's days close by the clock of the others


def test_a_late_record_changes_nothing_that_is_closed(spark, tmp_path):
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    at = lambda m, d: dt.datetime(2024, m, d, 6)
    for rows in (
        [(1, at(1, 1), 1.0, 1.0, 0.0), (1, at(1, 2), 3.0, 2.0, 0.0), (None, at(1, 2), 1.0, 1.0, 1.0), (1, None, 9.0, 9.0, 9.0)],
        [(1, at(3, 1), 7.0, 4.0, 0.0), (None, at(3, 2), 4.0, 2.0, 1.0)],
        [(1, at(1, 2), 100.0, 100.0, 0.0), (1, at(3, 2), 8.0, 6.0, 0.0)],
    ):
        spark.createDataFrame(rows, RECORDS).write.mode("append").parquet(source)
        rd.run_register_days(spark.readStream.schema(RECORDS).parquet(source), out, mark, late="10 days")
    assert listed(rd.current_days(spark, out)) == [
        (False, None, dt.date(2024, 3, 2), 3.0, 1.0, 4.0),
        (True, 1, dt.date(2024, 1, 2), 2.0, 1.0, 3.0),
        (True, 1, dt.date(2024, 3, 1), 4.0, 2.0, 6.0),
        (True, 1, dt.date(2024, 3, 2), 1.0, 2.0, 3.0),
    ]


def test_no_records_give_no_days(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1.0, 1.0, 1.0)], RECORDS).write.parquet(source)
    rd.run_register_days(spark.readStream.schema(RECORDS).parquet(source), out, mark)
    assert rd.current_days(spark, out).count() == 0
