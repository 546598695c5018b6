import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from paceline.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session("tests", cores="8", partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def frame(spark):
    """Build a frame from rows of plain values; dates are ISO text in columns named race_date."""
    from pyspark.sql import functions as F

    def make(schema, rows):
        text = schema.replace("race_date date", "race_date string")
        df = spark.createDataFrame([tuple(r) for r in rows], text)
        if "race_date date" in schema:
            df = df.withColumn("race_date", F.col("race_date").cast("date"))
        return df

    return make
