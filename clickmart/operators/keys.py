"""Joins whose NULL keys cannot match but would all hash to one partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_JOIN_KEY = "_jk"


def join_spreading_nulls(left: DataFrame, right: DataFrame, key: str, right_key: str,
                         salt: list[str], how: str = "left") -> DataFrame:
    """``left <how> JOIN right ON left.key = right.right_key`` (string keys).

    Equality never matches a NULL key, yet a shuffle join sends every NULL
    key to the same partition -- one task for what may be a large share of
    the rows. Here NULL keys are replaced, for partitioning only, by a salt
    hashed from ``salt`` columns (deterministic, so retried tasks agree),
    and the condition still requires a non-NULL key: same result, no hot
    partition. ``how`` is ``left`` or ``left_anti``.
    """
    k = F.col(key)
    salted = F.coalesce(k, F.concat(F.lit("\u0000"), F.xxhash64(*salt).cast("string")))
    lhs = left.withColumn(_JOIN_KEY, salted)
    rhs = right.where(F.col(right_key).isNotNull())
    cond = (F.col(_JOIN_KEY) == F.col(right_key)) & k.isNotNull()
    return lhs.join(rhs, cond, how).drop(_JOIN_KEY)
