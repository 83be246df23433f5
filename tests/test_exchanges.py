"""How often rows of a meter are dealt out, with broadcasts off."""

import pytest

from meterloom.plans import forecast
from meterloom.sources import driver_tables as src
from tests.conftest import SF


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def keys(df):
    """Partitioning expressions of all exchanges of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("hashpartitioning(")[1].split("), ")[0] for line in plan.splitlines() if "hashpartitioning(" in line]


def test_scenarios_are_not_dealt_out_by_month_or_station(spark, no_broadcast):
    rows = forecast.scenario_table(src.readings(spark, SF), src.weather(spark, SF), src.stations(spark, SF))
    found = keys(rows)
    assert found and not any("station_id" in k or "month_start" in k for k in found)
    # readings per date for raw and cleaned days, the rows by meter, the station map
    assert sum("meter_id" in k for k in found) <= 7


def test_months_are_matched_one_to_one(spark):
    """A month without label drops out, and a label without days makes no row."""
    from pyspark.sql import functions as F

    from meterloom.operators import scenarios

    days = spark.sql("SELECT m AS meter_id, date_add(date'2024-01-01', i) AS date, 1.0 AS offpeak_kwh, 2.0 AS onpeak_kwh, 3.0 AS total_kwh FROM (SELECT explode(sequence(1, 3)) AS m), (SELECT explode(sequence(0, 70)) AS i)")
    monthly = spark.sql("SELECT * FROM VALUES (1, date'2024-01-01', 2024, 1, 'inverno', 10.0), (1, date'2024-05-01', 2024, 5, 'primavera', 11.0), (2, date'2024-02-01', 2024, 2, 'inverno', 12.0) AS t(meter_id, month_start, year, month, season, bill)")
    got = scenarios.partial_month_scenarios(days, monthly).groupBy("meter_id", "month_start", "bill").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {(r.meter_id, r.month_start.month, float(r.bill), r.n) for r in got} == {(1, 1, 10.0, 4), (2, 2, 12.0, 4)}
