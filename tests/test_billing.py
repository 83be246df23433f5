import pytest
from pyspark.sql import functions as F

from meterloom.functions.billing import Tariff, add_bill, with_bill

# off-peak, on-peak, days -> bill, energy, power, audiovisual, exploitation, special
GOLDEN = [
    (150.5, 85.3, 31, 48.634618, 30.773364, 14.489400, 3.078937, 0.002883, 0.290034),
    (100, 50, 30, 35.405007, 18.216100, 14.022000, 2.979616, 0.002790, 0.184500),
    (100, 100, 30, 45.001207, 27.750800, 14.022000, 2.979616, 0.002790, 0.246000),
    (100, 100.01, 30, 46.909643, 29.659224, 14.022000, 2.979616, 0.002790, 0.246012),
    (0, 0, 31, 17.571220, 0, 14.489400, 3.078937, 0.002883, 0),
    (-5, 10, 30, 17.004407, 0, 14.022000, 2.979616, 0.002790, 0),
    (10, 5, 0, 17.127267, 0.104410, 14.022000, 2.979616, 0.002790, 0.018450),
    (10, 2, 10, 5.682896, 0, 4.674000, 0.993205, 0.000930, 0.014760),
    (300, 200, 31, 92.606120, 74.419900, 14.489400, 3.078937, 0.002883, 0.615000),
]


@pytest.fixture(scope="module")
def priced(spark):
    df = spark.createDataFrame(
        [(i, float(a), float(b), d) for i, (a, b, d, *_) in enumerate(GOLDEN)], "i int, off double, onp double, days int"
    )
    return add_bill(df, "b", "off", "onp", "days", breakdown=True).orderBy("i").collect()


@pytest.mark.parametrize("i", range(len(GOLDEN)))
def test_golden(priced, i):
    b = priced[i].b
    got = (b.bill, b.energy, b.power, b.audiovisual, b.exploitation, b.special)
    assert got == pytest.approx(GOLDEN[i][3:], abs=1e-6)
    assert len(b) == 16


def test_tariff_columns_and_existing_bill(spark):
    df = spark.createDataFrame(
        [(100.0, 50.0, 30, 0.0), (100.0, 50.0, 30, 1.8)], "offpeak_kwh double, onpeak_kwh double, days_in_month int, d double"
    )
    a, b = [r.bill for r in add_bill(df, tariff=Tariff(discount=F.col("d"))).collect()]
    assert a - b == pytest.approx(1.8 * 1.06)
    kept = with_bill(df.withColumn("bill", F.lit(1.0)))
    assert {r.bill for r in kept.collect()} == {1.0}
