"""Training and test sets: cuts, samples, projections, null routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridecast.config import (
    BASIC,
    FOLD_START_DAYS,
    FULL,
    MONTHS_AHEAD,
    SAMPLE_SEED,
    FeatureSpec,
)
from stridecast.functions.dates import Day, before, typed
from stridecast.functions.sampling import in_fraction, sampling_hash
from stridecast.operators.folds import fold_number, in_fold, in_horizon
from stridecast.sources.shared import written

# Leading hex digits of the sampling hash that are counted, level by level, to find
# the n-th key. A level has 16**3 groups, few enough to be combined before the
# shuffle by any task; the keys sharing six digits are about one in 16 million.
_DIGITS = (3, 6, 32)


def train_rows(df: DataFrame, date: str, split: Day) -> DataFrame:
    """Rows strictly before the split; the same cut serves every fold."""
    return df.where(before(typed(df, date), split))


def train_test(
    df: DataFrame,
    date: str,
    split: Day,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
) -> DataFrame:
    """Training and test rows in one pass, with ``role`` and ``fold``.

    Training rows serve all folds and carry a null fold.
    """
    date = typed(df, date)
    is_train = before(date, split)
    return df.where(is_train | in_horizon(date, split, starts, months_ahead)).withColumns(
        {
            "role": F.when(is_train, "train").otherwise("test"),
            "fold": F.when(~is_train, fold_number(date, split, starts)),
        }
    )


def sampled_train_test(
    df: DataFrame,
    date: str,
    split: Day,
    fraction: float,
    keys: Sequence[str],
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """``train_test`` with a share of the training rows, chosen by row key. One pass.

    It holds what ``split_frames`` gives as one frame per fold: the rows of role
    ``train`` once for all folds, and each test row with its fold.
    """
    rows = train_test(df, date, split, starts, months_ahead)
    return rows.where((F.col("role") == "test") | in_fraction(keys, fraction, seed))


def train_filters(
    date: str, split: Day, starts: tuple[int, ...] = FOLD_START_DAYS
) -> list[Column]:
    """The training cut, once per fold."""
    return [before(date, split) for _ in starts]


def fold_filters(
    date: str,
    split: Day,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
) -> list[Column]:
    """The days of each fold."""
    return [in_fold(date, split, i, starts, months_ahead) for i in range(len(starts))]


def split_train(
    frames: Sequence[DataFrame],
    filters: Sequence[Column],
    training_sample: float = 1.0,
    keys: Sequence[str] = (),
) -> list[DataFrame]:
    """The training part of each fold's frame, sampled."""
    parts = zip(frames, filters, strict=True)
    return [sample_training(f.where(cut), training_sample, keys) for f, cut in parts]


def split_test(frames: Sequence[DataFrame], filters: Sequence[Column]) -> list[DataFrame]:
    """The test part of each fold's frame."""
    return [f.where(days) for f, days in zip(frames, filters, strict=True)]


def split_frames(
    frames: Sequence[DataFrame],
    train: Sequence[Column],
    test: Sequence[Column],
    training_sample: float = 1.0,
    keys: Sequence[str] = (),
) -> tuple[list[DataFrame], list[DataFrame]]:
    """Training and test parts of per-fold frames, whose columns may differ by fold."""
    return split_train(frames, train, training_sample, keys), split_test(frames, test)


def sample_training(
    df: DataFrame, size: float, keys: Sequence[str] = (), seed: int = SAMPLE_SEED
) -> DataFrame:
    """A share of the rows (``size`` up to 1) or that many rows (above 1).

    With ``keys`` the choice depends on the row key alone. Without, a share is a
    seeded Bernoulli sample, which changes with the partitioning; a number of
    rows needs keys.
    """
    if size > 1:
        return sample_count(df, keys, int(size), seed)
    if size == 1:
        return df
    return sample_fraction(df, keys, size, seed) if keys else df.sample(False, size, seed)


def sample_fraction(
    df: DataFrame, keys: Sequence[str], fraction: float, seed: int = SAMPLE_SEED
) -> DataFrame:
    """About ``fraction`` of the rows, chosen by row key: a filter, no shuffle."""
    return df.where(in_fraction(keys, fraction, seed))


def sample_count(
    df: DataFrame, keys: Sequence[str], n: int, seed: int = SAMPLE_SEED
) -> DataFrame:
    """The ``n`` rows first in the order of their key's hash.

    ``keys`` should identify a row; of the copies of the last key so many are taken
    that ``n`` rows come out.
    The last hash to keep is found at once, by two scans of the keys: one counts the rows
    per leading digits of the hash, the other writes the hashes of the group in which the
    running count reaches ``n``, with their rows, to the shared folder. What is left is
    decided there, one in 4,096 rows or a hot key counted up. The rows themselves
    only pass a filter; they are neither shuffled nor sorted.
    """
    if not keys:
        raise ValueError("sampling a number of rows needs the columns that identify a row")
    digest = sampling_hash(keys, seed)
    hashes = df.select(digest.alias("_digest"), F.lit(1).alias("_rows"))
    ahead, last = 0, None
    for digits in _DIGITS:
        if last is not None:
            hashes = hashes.where(F.startswith("_digest", F.lit(last)))
            if digits == _DIGITS[1]:
                counts = hashes.groupBy("_digest").agg(F.sum("_rows").alias("_rows"))
                hashes = written(counts, "sample")
        edge = _edge(hashes, digits, n - ahead)
        if edge is None:
            return df
        last, ahead = edge.prefix, ahead + edge.upto - edge.rows
    if ahead + edge.rows == n:
        return df.where(digest <= last)
    return df.where(digest < last).unionByName(df.where(digest == last).limit(n - ahead))


def _edge(hashes: DataFrame, digits: int, n: int) -> Row | None:
    """The first ``prefix`` of so many digits up to which there are ``n`` rows, with its
    ``rows`` and those ``upto`` it; None if there are fewer."""
    per_prefix = hashes.groupBy(F.substring("_digest", 1, digits).alias("prefix")).agg(
        F.sum("_rows").alias("rows")
    )
    upto = F.sum("rows").over(W.orderBy("prefix"))
    reached = per_prefix.withColumn("upto", upto).where(F.col("upto") >= n)
    return reached.agg(F.min_by(F.struct("prefix", "rows", "upto"), "prefix").alias("edge")).first().edge


def lacks(df: DataFrame, columns: Sequence[str]) -> Column:
    """True where any of the columns is null or, as a float, not a number."""
    flag = F.lit(False)
    for c in columns:
        flag = flag | F.col(c).isNull()
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            flag = flag | F.isnan(c)
    return flag


def flag_basic(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Marks the rows that lack a feature and need the basic model."""
    return df.withColumn("is_basic", lacks(df, features))


def with_variant(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds the ``variant`` of the model each row goes to. One pass for both."""
    return df.withColumn("variant", F.when(lacks(df, features), BASIC).otherwise(FULL))


def route_nulls(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all features, and rows that lack one."""
    return df.where(~lacks(df, features)), df.where(lacks(df, features))


def project_fold(
    df: DataFrame, spec: FeatureSpec, fold: int, variant: str = FULL, with_target: bool = True
) -> DataFrame:
    """The columns one fold's model needs: ids, date, target, features, categories."""
    target = [spec.target] if with_target else []
    columns = [*spec.ids, spec.date, *target, *spec.numeric(fold, variant), *spec.categorical]
    return df.select(*dict.fromkeys(columns))


def fold_variant(
    df: DataFrame, spec: FeatureSpec, fold: int, variant: str = FULL, with_target: bool = True
) -> DataFrame:
    """Rows and columns of one fold's full or basic model."""
    full, lacking = route_nulls(df, spec.numeric(fold, FULL))
    return project_fold(lacking if variant == BASIC else full, spec, fold, variant, with_target)
