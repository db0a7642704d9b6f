"""Feature engineering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridecast.config import COS, MINORITY_LABEL, SIN
from stridecast.functions.encode import angle, keep_or_minority
from stridecast.operators.lookup import BROADCAST_BYTES, ROWS_PER_TASK, attach
from stridecast.operators.split import lacks
from stridecast.sources.shared import written

#: Columns with at most about so many values are counted by gathering them in sets.
MOST_IN_SETS = 10_000

# A day number no date has; rows without a date form their own day.
_NO_DAY = -(10**9)


def distinct_values(
    df: DataFrame, columns: Sequence[str], most_in_sets: int = MOST_IN_SETS
) -> DataFrame:
    """One row with the exact number of distinct values per column, null being a value.

    Several distinct counts in one aggregate would make a row of every row and column.
    So a sketch, taken at once, tells the columns with few values: their sets are
    gathered side by side in one pass. Each other column (more than about ``most_in_sets``
    values) is counted in a pass of its own.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        raise ValueError("no columns to count")
    sketched = df.agg(*(F.approx_count_distinct(F.col(c)).alias(c) for c in columns)).first()

    def has_null(c: str) -> Column:
        return F.coalesce(F.max(F.isnull(c).cast("int")), F.lit(0))

    def in_set(c: str) -> Column:
        if not isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            return F.size(F.collect_set(c)).cast("long")
        # -0.0 is 0.0, and all that is not a number is one value; sets tell them apart.
        values = F.size(F.collect_set(F.when(~F.isnan(c), F.col(c) + 0.0))).cast("long")
        return values + F.coalesce(F.max(F.isnan(c).cast("int")), F.lit(0))

    def counted(c: str) -> DataFrame:
        return df.select(c).distinct().agg(F.count(F.lit(1)).alias(c))

    few = [c for c in columns if sketched[c] <= most_in_sets]
    alone = [c for c in columns if c not in few]
    if few:
        found = df.agg(*((in_set(c) + has_null(c)).alias(c) for c in few))
    else:
        found = counted(alone.pop(0))
    rest = {c: counted(c).scalar() for c in alone}
    return found.select(*(rest[c].alias(c) if c in rest else c for c in columns))


def cyclical(
    df: DataFrame,
    columns: Sequence[str],
    periods: Mapping[str, float] | None = None,
    drop: bool = False,
) -> DataFrame:
    """Adds sine and cosine of each column's place in its cycle.

    The period of a column is its number of distinct values in ``df``, all of
    them counted in one pass; ``periods`` fixes them instead, so that training
    and scoring data cannot disagree.
    """
    given = dict(periods or {})
    counted = [c for c in columns if c not in given]
    out = df
    if counted:
        counts = distinct_values(df, counted).select(F.struct(*counted).alias("p")).scalar()
        out = out.withColumn("_periods", counts)
    waves = {}
    for c in columns:
        a = angle(c, given[c] if c in given else F.col("_periods")[c].cast("double"))
        waves[c + SIN], waves[c + COS] = F.sin(a), F.cos(a)
    return out.withColumns(waves).drop("_periods", *(columns if drop else ()))


def group_totals(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Adds each row's group total as ``sum_<column>_by_<key>``.

    Rows with a null key belong to no group and are left out. One pass aggregates the
    totals with the rows per key into a table in the shared folder, at once; a second
    pass attaches them to the rows (see ``lookup.attach``).
    """
    names = {c: f"sum_{c}_by_{key}" for c in columns}
    keyed = df.drop(*names.values()).where(F.col(key).isNotNull())
    totals = keyed.groupBy(key).agg(
        *(F.sum(c).alias(n) for c, n in names.items()), F.count(F.lit(1)).alias("_rows")
    )
    return attach(keyed, written(totals, "totals"), [key], "_rows", broadcast_bytes, rows_per_task)


def trailing_totals(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    date: str,
    days: int,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Adds group totals over the trailing ``days`` days, the row's own day included.

    One pass adds the rows up by key and day. The window runs over one row per key and
    day, so a group has no more rows than there are days, and its values go to a table
    in the shared folder, at once. A second pass attaches them to the rows (see
    ``lookup.attach``). Named ``sum_<column>_by_<key>_<days>d``.
    """
    names = {c: f"sum_{c}_by_{key}_{days}d" for c in columns}
    day = F.coalesce(F.unix_date(F.to_date(date)), F.lit(_NO_DAY))
    keyed = df.drop(*names.values()).where(F.col(key).isNotNull()).withColumn("_day", day)
    daily = keyed.groupBy(key, "_day").agg(
        *(F.sum(c).alias(n) for c, n in names.items()), F.count(F.lit(1)).alias("_rows")
    )
    trailing = W.partitionBy(key).orderBy("_day").rangeBetween(-(days - 1), 0)
    rolled = daily.select(
        key, "_day", "_rows", *(F.sum(n).over(trailing).alias(n) for n in names.values())
    )
    table = written(rolled, "trailing")
    return attach(keyed, table, [key, "_day"], "_rows", broadcast_bytes, rows_per_task).drop("_day")


def relabel_minority(
    df: DataFrame, label: str, total: str, threshold: float, minority: str = MINORITY_LABEL
) -> DataFrame:
    """Replaces labels whose total does not exceed the threshold."""
    return df.withColumn(label, keep_or_minority(label, total, threshold, minority))


def relabel_by_total(
    df: DataFrame, label: str, amount: str, threshold: float, minority: str = MINORITY_LABEL
) -> DataFrame:
    """Replaces labels that do not exceed the threshold with their summed amount."""
    total = f"sum_{amount}_by_{label}"
    return relabel_minority(group_totals(df, [amount], label), label, total, threshold, minority)


def categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Distinct non-missing values per column, as text, in the order of the column's type.

    However many there are: each becomes a column of its own in ``dummies``, so they
    are all needed where the plan is made.
    """
    values = []
    for i, c in enumerate(columns):
        value = F.col(c)
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            value = F.when(~F.isnan(c), value)
        values.append(F.struct(F.lit(i).alias("i"), value.cast("string").alias("value")))
    found = df.select(F.inline(F.array(*values))).where(F.col("value").isNotNull()).distinct().collect()
    out: dict[str, list[str]] = {}
    for i, c in enumerate(columns):
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        out[c] = sorted((r.value for r in found if r.i == i), key=Decimal if numeric else None)
    return out


def dummies(
    df: DataFrame,
    columns: Sequence[str],
    known: Mapping[str, Sequence[str]] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Replaces each column by 0/1 columns ``<column>_<value>``; also returns their names.

    The first category has no column of its own, a missing value is 0 throughout,
    and columns that ``df`` lacks are skipped. ``known`` gives the categories of a
    column, so that no pass over the data is needed to find them.
    """
    present = [c for c in columns if c in df.columns]
    known = dict(known or {})
    unknown = [c for c in present if c not in known]
    if unknown:
        known.update(categories(df, unknown))
    flags = {
        f"{c}_{value}": F.coalesce((F.col(c).cast("string") == value).cast("int"), F.lit(0))
        for c in present
        for value in known[c][1:]
    }
    kept = [c for c in df.columns if c not in present]
    return df.select(*kept, *(flag.alias(name) for name, flag in flags.items())), list(flags)


def numbered(values: DataFrame, order: Sequence[Column], place: str = "_place") -> DataFrame:
    """``values`` with ``place``, their number from 0 in the given order; a table in the
    shared folder, made at once.

    Values are sorted by ranges and numbered within each range, so no task and not the
    driver sees them all. The order should be total.
    """
    ranges = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(
        values.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()),
        "categories",
    )
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    within = W.partitionBy("_range").orderBy(*order)
    found = placed.withColumn("_in_range", F.row_number().over(within) - 1).join(
        F.broadcast(starts), "_range"
    )
    kept = [c for c in values.columns if c != place]
    return written(found.select(*kept, (F.col("_start") + F.col("_in_range")).alias(place)), "places")


def category_table(df: DataFrame, column: str) -> DataFrame:
    """Every non-missing value of ``column`` with ``_place`` in their order, from 0, and
    ``_rows``, their number; a table in the shared folder, made at once (see ``numbered``)."""
    values = df.where(~lacks(df, [column])).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    return numbered(values, [F.col(column)]).select(column, "_place", "_rows")


def dummy_vector(
    df: DataFrame,
    column: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Replaces a column by ``<column>_vec``: ``dummies`` as one sparse vector per row.

    For any number of categories, of which neither the plan nor the driver holds a list.
    The first category and a missing value have no slot; the others follow in the order
    of their type.
    """
    known = category_table(df, column)
    size = known.count()
    found = attach(df, known, [column], "_rows", broadcast_bytes, rows_per_task, "left")
    # The encoder gives its last category no slot: that is where the first one goes.
    slot = F.coalesce(F.nullif("_place", F.lit(0)) - 1, F.lit(max(size - 1, 0))).cast("double")
    found = found.withColumn("_slot", slot).drop("_place", column)
    widest = df.sparkSession.createDataFrame([(float(max(size - 1, 0)),)], "_slot double")
    encoder = OneHotEncoder(inputCol="_slot", outputCol=f"{column}_vec", dropLast=True)
    return encoder.fit(widest).transform(found).drop("_slot")
