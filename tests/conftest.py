import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="clickmart-tests", shuffle_partitions=8)
    yield s


def raw_df(spark, events):
    """Raw layer from literal events: list of (dict, filename)."""
    from pyspark.sql import functions as F

    rows = [(json.dumps(e), f) for e, f in events]
    df = spark.createDataFrame(rows, "json_text string, filename string")
    return df.select(F.parse_json("json_text").alias("json_data"), "filename")


def event(uuid, session, t, etype="[Amplitude] Page Viewed", device="d1", url=None, **extra):
    e = {"uuid": uuid, "session_id": session, "device_id": device, "device_type": "m1",
         "device_family": "f1", "platform": "iOS", "os_version": "1.0", "os_name": "os1",
         "event_type": etype, "event_time": t, "event_properties": {}}
    if url is not None:
        e["event_properties"]["[Amplitude] Page URL"] = url
    e.update(extra)
    return e
