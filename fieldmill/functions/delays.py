"""Delay flags and labels."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def is_later(actual: Column, scheduled: Column) -> Column:
    """1 when ``actual`` is after ``scheduled``, else 0; an unknown side counts as 0.

    Both sides are compared as numbers, so 930 is before 1015. A clock time past midnight is still
    smaller than the schedule of the evening before; where that matters, test the delay in minutes.
    """
    later = actual.try_cast("int") > scheduled.try_cast("int")
    return F.coalesce(later.cast("int"), F.lit(0))


def majority_label(share: Column, above: str = "late", otherwise: str = "early") -> Column:
    """``above`` when more than half of the 0/1 flags behind ``share`` are set."""
    return F.when(share > 0.5, above).when(share.isNotNull(), otherwise)


def timing_label(mean_delay: Column, late: float = 15, early: float = 0) -> Column:
    """Late above ``late``, Early below ``early``, On-time between (both ends included)."""
    return (
        F.when(mean_delay > late, "Late")
        .when(mean_delay < early, "Early")
        .when(mean_delay.isNotNull(), "On-time")
    )


def timing_label_udf(mean_delay: Column, late: float = 15, early: float = 0) -> Column:
    """:func:`timing_label` through a vectorized Python function.

    The expression above is the faster one; this is for rules that Python has to decide. Use it on
    grouped results rather than on raw rows.
    """

    # Defined inside, so that it travels to the executors by value.
    @F.pandas_udf(StringType())
    def label(means: pd.Series) -> pd.Series:
        labels = np.select([means > late, means < early], ["Late", "Early"], "On-time")
        return pd.Series(labels, index=means.index, dtype=object).where(means.notna(), None)

    return label(mean_delay)
