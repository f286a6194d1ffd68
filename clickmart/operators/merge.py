"""Device dimension upsert (slowly changing, type 1) as a pure function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart import schemas as S

# Profile columns compared to detect a change, and those the update writes.
COMPARED = ["device_type", "device_family", "platform", "os_version", "os_name"]
UPDATED = ["device_type", "device_family", "os_version", "os_name"]


def changed(t_prefix: str = "t_", s_prefix: str = "s_"):
    """Null-safe 'any compared column differs' between target and source."""
    cond = F.lit(False)
    for c in COMPARED:
        cond = cond | ~F.col(t_prefix + c).eqNullSafe(F.col(s_prefix + c))
    return cond


def merge_devices(target: DataFrame, source: DataFrame) -> DataFrame:
    """The device table after ``MERGE target USING source ON device_id``.

    * matched and changed: ``UPDATED`` columns take the source values;
      ``platform`` and ``load_timestamp`` keep the target's (the update list
      leaves them out, so a platform change alone alters nothing);
    * matched and unchanged: row kept as is (equal to the above, the
      condition only saves writes);
    * source row without match -- including every NULL ``device_id``, which
      equality never matches -- is inserted with the source's values;
    * target rows without a source row are kept.

    A full outer join on the key gives all four cases in one shuffle.
    """
    t = target.select(F.lit(True).alias("t_present"),
                      *[F.col(c).alias("t_" + c) for c in S.DEVICES_COLUMNS])
    s = source.select(F.lit(True).alias("s_present"),
                      *[F.col(c).alias("s_" + c) for c in S.DEVICES_COLUMNS])
    j = t.join(s, F.col("t_device_id") == F.col("s_device_id"), "full_outer")
    in_t, in_s = F.col("t_present").isNotNull(), F.col("s_present").isNotNull()
    matched = in_t & in_s

    def pick(c: str):
        if c in UPDATED:
            return F.when(matched & changed(), F.col("s_" + c)).when(in_t, F.col("t_" + c)).otherwise(F.col("s_" + c))
        return F.when(in_t, F.col("t_" + c)).otherwise(F.col("s_" + c))

    return j.select(*[pick(c).alias(c) for c in S.DEVICES_COLUMNS])


def merge_stats(target: DataFrame, source: DataFrame) -> DataFrame:
    """Rows updated / inserted by the merge (the counts the warehouse reports)."""
    t = target.select(*[F.col(c).alias("t_" + c) for c in S.DEVICES_COLUMNS])
    s = source.select(*[F.col(c).alias("s_" + c) for c in S.DEVICES_COLUMNS])
    j = t.join(s, F.col("t_device_id") == F.col("s_device_id"), "right")
    return j.agg(
        F.count_if(F.col("t_device_id").isNotNull() & changed()).alias("rows_updated"),
        F.count_if(F.col("t_device_id").isNull()).alias("rows_inserted"),
    )
