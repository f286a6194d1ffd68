"""High-water marks and the rows they keep out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.operators.keys import join_spreading_nulls

MARK_COLUMN = "extract_timestamp"
# Day of MARK_COLUMN; stored tables are partitioned by it (plans.store).
PARTITION_COLUMN = "extract_date"


def mark_of(target: DataFrame, default: str | None, column: str = MARK_COLUMN) -> Column:
    """``(SELECT COALESCE(MAX(column), default) FROM target)`` as a scalar
    subquery: Spark runs it once and uses the value as a literal."""
    top = F.max(column)
    if default is not None:
        top = F.coalesce(top, F.lit(default).cast("timestamp_ntz"))
    return target.select(top.alias("mark")).scalar()


def above_mark(df: DataFrame, mark: Column, column: str = MARK_COLUMN) -> DataFrame:
    """Rows strictly above the mark; a NULL mark or NULL stamp keeps nothing.

    When ``df`` carries the partition day of ``column``, the implied
    condition ``day >= day(mark)`` is added: it drops no row the stamp
    condition keeps, and lets the scan skip whole days below the mark.
    """
    if column == MARK_COLUMN and PARTITION_COLUMN in df.columns:
        df = df.where(F.col(PARTITION_COLUMN) >= F.to_date(mark))
    return df.where(F.col(column) > mark)


def high_water_marks(targets: dict[str, DataFrame], column: str = MARK_COLUMN) -> DataFrame:
    """The raw ``MAX(column)`` of every target table, one row per table."""
    rows = [df.agg(F.lit(name).alias("table_name"), F.max(column).alias("mark"))
            for name, df in targets.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def late_rows(base: DataFrame, fct: DataFrame) -> DataFrame:
    """Base rows that never reached the fact: a second file of an already
    loaded hour, an older hour arriving late, or a file name without hour."""
    f = fct.select(F.col("event_uuid").alias("f_event_uuid"))
    return join_spreading_nulls(base, f, "event_uuid", "f_event_uuid",
                                salt=["session_id", "event_time", "load_timestamp"], how="left_anti")
