"""Micro-fixtures with results worked out by hand, and properties of the daily series."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterloom.functions.billing import with_bill
from meterloom.operators import monthly, quality, scenarios, series
from meterloom.plans import forecast

RESET = [
    (1, "2024-01-01", 100, 50, 30), (1, "2024-01-02", 110, 55, 31), (1, "2024-01-03", 125, 60, 33),
    (1, "2024-01-04", 5, 2, 1), (1, "2024-01-05", 12, 4, 3),
]
DUPLICATE = [
    (2, "2024-03-01", 10, 1, 1), (2, "2024-03-02", 12, 2, 1), (2, "2024-03-02", 12, 2, 1), (2, "2024-03-03", 15, 3, 2),
]
NULLS = [
    (3, "2024-04-01", 1, 5, 1), (3, "2024-04-02", 2, None, 1), (3, "2024-04-03", 4, 6, 2), (3, "2024-04-04", 7, 8, 2),
]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def chain(readings, policy="sum"):
    return series.daily_consumption(series.fill_readings(series.dedupe_readings(readings, policy)))


def test_reset_outlier_and_partial_month(readings_of):
    r = readings_of(RESET)
    assert rows(chain(r), "offpeak_kwh", "onpeak_kwh", "total_kwh") == [
        (7.0, 4.0, 11.0), (10.0, 6.0, 16.0), (15.0, 7.0, 22.0), (120.0, 90.0, 210.0)
    ]
    flagged = series.flag_outlier_days(chain(r)).where("is_outlier").collect()
    assert [(x.date, x.low, x.high) for x in flagged] == [(dt.date(2024, 1, 4), -66.625, 150.375)]
    clean = series.clean_daily(r)
    assert rows(clean.where("is_outlier"), "offpeak_kwh", "onpeak_kwh", "total_kwh") == [(10.0, 6.0, 16.0)]
    m = with_bill(monthly.monthly_consumption(clean)).first()
    assert (m.days_with_data, m.days_in_month) == (4, 31)
    assert (m.offpeak_kwh, m.onpeak_kwh, m.total_kwh, m.kwh_per_day) == (325.5, 178.25, 503.75, 16.25)
    assert m.offpeak_ratio == pytest.approx(0.646154, abs=1e-6)
    assert m.bill == pytest.approx(91.056860, abs=1e-6)
    resets = series.meter_resets(series.fill_readings(series.dedupe_readings(r))).first()
    assert (resets.reset_days, resets.days) == (1, 4)


def test_duplicate_dates_add_up(readings_of):
    r = readings_of(DUPLICATE)
    report = quality.duplicate_report(r).first()
    assert (report.duplicate_rows, report.duplicate_dates) == (2, 1)
    assert rows(series.dedupe_readings(r), "reg_offpeak", "reg_onpeak") == [(10.0, 2.0), (15.0, 5.0), (24.0, 6.0)]
    assert rows(chain(r), "date", "offpeak_kwh", "onpeak_kwh") == [
        (dt.date(2024, 3, 2), 14.0, 4.0), (dt.date(2024, 3, 3), 9.0, 1.0)
    ]
    assert rows(chain(r, "max"), "offpeak_kwh", "onpeak_kwh") == [(2.0, 1.0), (3.0, 2.0)]


def test_null_register_without_duplicates_drops_two_days(readings_of):
    r = readings_of(NULLS)
    filled = series.fill_readings(series.dedupe_readings(r))
    assert [x.reg_peak for x in filled.orderBy("read_date").collect()] == [5, 5, 6, 8]
    assert [x.reg_onpeak for x in filled.orderBy("read_date").collect()] == [6, None, 8, 10]
    assert rows(chain(r), "date", "offpeak_kwh", "onpeak_kwh") == [(dt.date(2024, 4, 4), 3.0, 2.0)]


def test_null_register_with_a_duplicate_counts_as_zero(readings_of):
    r = readings_of([*NULLS, (3, "2024-04-05", 7, 8, 2), (3, "2024-04-05", 0, 0, 0)])
    daily = chain(r).orderBy("date").collect()
    assert [x.onpeak_kwh for x in daily] == [6.0, 8.0, 2.0, 0.0]


def test_leading_null_is_filled_with_zero(readings_of):
    r = readings_of([(1, "2024-01-01", None, 1, 1), (1, "2024-01-02", 5, 2, 1)])
    first = series.fill_readings(series.dedupe_readings(r)).orderBy("read_date").first()
    assert first.reg_offpeak == 0.0


def test_total_of_differences_is_last_minus_first(readings_of):
    r = readings_of([(1, f"2024-01-{d:02d}", 3 * d * d, d, 2 * d) for d in range(1, 29)])
    total = chain(r).agg(F.sum("offpeak_kwh"), F.sum("onpeak_kwh")).first()
    assert tuple(total) == (3 * 28 * 28 - 3, 81)


def test_other_meters_do_not_change_a_meter(readings_of):
    alone = series.clean_daily(readings_of(RESET))
    together = series.clean_daily(readings_of(RESET + DUPLICATE + NULLS)).where("meter_id = 1")
    assert rows(alone, *alone.columns) == rows(together, *alone.columns)


def snapshot_days(spark):
    days = [3, 8, 9, 12, 14, 18, 22, 24, 27]
    df = spark.createDataFrame(
        [(4, dt.date(2024, 2, d), float(i), 2.0, i + 2.0) for i, d in enumerate(days, 1)],
        "meter_id bigint, date date, offpeak_kwh double, onpeak_kwh double, total_kwh double",
    )
    return df


def test_scenarios_of_a_gappy_february(spark):
    daily = snapshot_days(spark)
    m = with_bill(monthly.monthly_consumption(daily))
    out = scenarios.partial_month_scenarios(daily, m).orderBy("cutoff_day").collect()
    got = [
        (r.cutoff_day, r.days_elapsed, r.days_remaining, r.cum_offpeak_kwh, r.cum_onpeak_kwh, r.cum_total_kwh,
         r.avg7_offpeak, r.avg7_onpeak, r.avg7_total, r.simulation_date.day, r.day_of_week) for r in out
    ]
    assert got == [
        (10, 3, 26, 6, 6, 12, 2, 2, 4, 9, 4),
        (15, 5, 24, 15, 10, 25, 3, 2, 5, 14, 2),
        (20, 6, 23, 21, 12, 33, 3.5, 2, 5.5, 18, 6),
        (25, 8, 21, 36, 16, 52, 5, 2, 7, 24, 5),
    ]
    assert [r.projected_bill for r in out] == pytest.approx([1.715201, 4.452168, 6.045573, 9.553756], abs=1e-6)
    assert {(r.temperature, r.humidity, r.occupancy) for r in out} == {(12.0, 80.0, 0)}


def test_late_and_early_months(spark):
    rows_ = [(1, dt.date(2024, 3, 12), 1.0), (1, dt.date(2024, 4, 5), 1.0), (1, dt.date(2024, 4, 9), 2.0)]
    daily = spark.createDataFrame(rows_, "meter_id bigint, date date, offpeak_kwh double").withColumns(
        {"onpeak_kwh": F.lit(0.0), "total_kwh": F.col("offpeak_kwh")}
    )
    snaps = scenarios.month_snapshots(daily)
    march = snaps.where("month_start = date'2024-03-01'").orderBy("cutoff_day").collect()
    assert [r.cutoff_day for r in march] == [15, 20, 25]
    april = snaps.where("month_start = date'2024-04-01'").collect()
    assert {r.simulation_date for r in april} == {dt.date(2024, 4, 9)} and len(april) == 4


def reference_raw(rows_):
    """Row by row: sort, difference, drop the first row; None spreads."""
    out = []
    ordered = sorted(rows_, key=lambda r: (r[1], r[2] is not None, r[2] or 0, (None not in (r[3], r[4])), (r[3] or 0) + (r[4] or 0)))
    for prev, cur in zip(ordered, ordered[1:]):
        on = lambda r: None if r[3] is None or r[4] is None else r[3] + r[4]
        sub = lambda a, b: None if a is None or b is None else abs(a - b)
        out.append((cur[1], sub(cur[2], prev[2]), sub(on(cur), on(prev))))
    return out


@pytest.mark.parametrize("copies", [1, 2, 7, 8, 9, 30])
def test_raw_days_with_many_copies_equal_the_row_by_row_result(readings_of, copies):
    source = [(1, "2024-01-01", 1, 1, 1)] * copies + [(1, "2024-01-02", 9, 3, 1)] * copies
    source += [(1, "2024-01-03", 11, None, 1)] * copies + [(1, "2024-01-04", 20, 5, 2), (1, "2024-01-05", 21, 6, 2)]
    expected = reference_raw(source)
    daily = series.raw_daily(readings_of(source))
    snap = scenarios.month_snapshots(daily).where("cutoff_day = 10").first()
    assert snap.days_elapsed == len(expected)
    total = lambda i: sum(r[i] or 0 for r in expected)
    assert (snap.cum_offpeak_kwh, snap.cum_onpeak_kwh) == (total(1), total(2))
    mean = lambda i: (lambda v: sum(v) / len(v) if v else None)([r[i] for r in expected[-7:] if r[i] is not None])
    assert (snap.avg7_offpeak, snap.avg7_onpeak) == (pytest.approx(mean(1)), pytest.approx(mean(2)))
    assert daily.count() <= 5


def test_raw_days_of_many_readings_a_date(spark, readings_of):
    """Dates of one to a few hundred different readings, with NULLs, falls and copies, against the row-by-row result."""
    rng = random.Random(5)
    for meter_days in ([1, 1, 300, 2, 1], [40, 1, 1, 9, 7, 8, 6], [1], [2], [120]):
        source = []
        for d, n in enumerate(meter_days, 1):
            for _ in range(n):
                value = lambda: None if rng.random() < 0.1 else rng.randrange(30)
                source += [(1, f"2024-01-{d:02d}", value(), value(), value())] * rng.choice((1, 1, 2))
        expected = reference_raw(source)
        got = {r.date.day: r for r in series.raw_daily(readings_of(source)).collect()}
        by_day = {}
        for date, off, on in expected:
            by_day.setdefault(int(date[-2:]), []).append((off, on))
        assert {d: r.n_rows for d, r in got.items()} == {d: len(v) for d, v in by_day.items()}
        for d, steps in by_day.items():
            for i, c in enumerate(("offpeak_kwh", "onpeak_kwh")):
                known = [s[i] for s in steps if s[i] is not None]
                assert got[d][c] == (sum(known) if known else None)
            shown = [(t.offpeak_kwh, t.onpeak_kwh) for t in got[d].tail]
            assert shown == steps[-7:] and len(shown) == min(7, len(steps))


def test_no_raw_row_is_dealt_out_by_meter_alone(spark, readings_of):
    """Only the exchange of finished dates has the meter as its one key, and it carries no single reading."""
    plan = series.raw_daily(readings_of([(1, "2024-01-01", 1, 1, 1)]))._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    keys_of = [line.split("hashpartitioning(")[1].split("), ")[0].split(", ")[:-1] for line in lines]
    assert sorted(len(k) for k in keys_of) == [1, 2, 4]


def test_a_million_readings_a_date(spark):
    """No task that orders readings gets more than the readings of one date."""
    n, days = 1_000_000, 3
    readings = spark.range(n * days).selectExpr(
        "1L AS meter_id", "date_add(date'2024-01-01', cast(id div 1000000 AS int)) AS read_date",
        "cast(id AS double) AS reg_offpeak", "cast(2 * id AS double) AS reg_peak", "0D AS reg_shoulder",
    )
    got = [(r.n_rows, r.offpeak_kwh, r.onpeak_kwh, len(r.tail)) for r in series.raw_daily(readings).orderBy("date").collect()]
    assert got == [(n - 1, n - 1, 2 * (n - 1), 7), (n, n, 2 * n, 7), (n, n, 2 * n, 7)]


def test_scenario_properties(spark):
    from tests.conftest import SF
    from meterloom.sources import driver_tables as src

    rows_ = forecast.scenario_table(src.readings(spark, SF), src.weather(spark, SF), src.stations(spark, SF)).collect()
    by_month = {}
    for r in rows_:
        assert r.bill >= 0 and r.projected_bill >= 0 and r.days_elapsed >= 1
        by_month.setdefault((r.meter_id, r.month_start), []).append(r)
    for group in by_month.values():
        group.sort(key=lambda r: r.cutoff_day)
        assert len(group) <= 4
        totals = [r.cum_total_kwh for r in group]
        assert totals == sorted(totals)
