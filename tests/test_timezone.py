"""Calendar parts, epoch and gaps do not depend on the session time zone
(the log's timestamps are wall-clock values without a zone)."""

from clickforge.plans.queries import QUERIES
from conftest import SF_SMALL


def test_results_independent_of_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    out = {}
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            out[tz] = {name: sorted(map(tuple, QUERIES[name](spark, SF_SMALL).collect()))
                       for name in ("calendar_parts", "next_gap", "day_filter", "time_block")}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert out["UTC"] == out["America/Los_Angeles"] == out["Asia/Kolkata"]
