"""Value encodings of one column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from stridecast.config import MINORITY_LABEL


def angle(value: Column | str, period: Column | float) -> Column:
    """Position on a circle of ``period`` steps, in radians; malformed text is null."""
    x = F.col(value) if isinstance(value, str) else value
    period = period if isinstance(period, Column) else F.lit(float(period))
    return F.try_divide(F.lit(2 * math.pi) * x.try_cast("double"), period)


def keep_or_minority(
    label: Column | str, total: Column | str, threshold: float, minority: str = MINORITY_LABEL
) -> Column:
    """The label where its total exceeds the threshold, else the minority label.

    A null or NaN total is not above any threshold.
    """
    label = F.col(label) if isinstance(label, str) else label
    total = (F.col(total) if isinstance(total, str) else total)
    above = (total > F.lit(threshold)) & ~F.isnan(total.cast("double"))
    return F.when(above, label.cast("string")).otherwise(F.lit(minority))
