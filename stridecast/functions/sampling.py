"""Sampling by row key: the same rows whatever the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stridecast.config import SAMPLE_SEED


def sampling_hash(keys: Sequence[str], seed: int = SAMPLE_SEED) -> Column:
    """Hex digest of the row key and the seed, uniform over rows with distinct keys.

    Of several keys each is preceded by its length, and a null key by none, so that no
    two rows are mistaken for each other.
    """
    texts = [F.col(k).cast("string") for k in keys]
    if len(texts) > 1:
        texts = [F.concat(F.char_length(t).cast("string"), F.lit(":"), t) for t in texts]
    parts = [F.coalesce(t, F.lit("null" if len(texts) == 1 else "")) for t in texts]
    return F.md5(F.concat_ws("#", *parts, F.lit(str(seed))))


def in_fraction(keys: Sequence[str], fraction: float, seed: int = SAMPLE_SEED) -> Column:
    """True for about ``fraction`` of the keys."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie in [0, 1]")
    if fraction == 1:
        return F.lit(True)
    return F.substring(sampling_hash(keys, seed), 1, 8) < F.lit(f"{int(fraction * 2**32):08x}")
