import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from meterloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def readings_of(spark):
    """Rows (meter, 'yyyy-mm-dd', off-peak, peak, shoulder) -> readings table."""
    from pyspark.sql import functions as F

    def build(rows):
        df = spark.createDataFrame(
            [(m, d, *[None if v is None else float(v) for v in regs]) for m, d, *regs in rows],
            "meter_id bigint, read_date string, reg_offpeak double, reg_peak double, reg_shoulder double",
        )
        return df.withColumn("read_date", F.to_date("read_date"))

    return build
