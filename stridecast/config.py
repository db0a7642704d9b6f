"""Plain settings: which columns play which role, and how the forest is grown."""

from __future__ import annotations

from dataclasses import dataclass

# First day of each horizon, in days after the split date. A
# horizon ends the day before the next one starts; the last one ends on the last
# day of the month this many months after the split.
FOLD_START_DAYS = (0, 8, 15, 33, 46, 64)
MONTHS_AHEAD = 5

# Column suffixes, sampling seed, outlier thresholds in percent,
# and the label that replaces minority categories.
SIN, COS = "_sin", "_cos"
INDEX, ONE_HOT = "_tmp", "_catVec"
PREDICTION = "_pred"
APE, AE, SE = "_APE", "_AE", "_SE"
SAMPLE_SEED = 23
OUTLIER_PERCENT = (50, 100)
MINORITY_LABEL = "minor_segment"

FULL, BASIC, UNSCORED = "full", "basic", "unscored"


@dataclass(frozen=True)
class FeatureSpec:
    """Column roles of a prepared table with one row per thing to forecast.

    ``features`` holds one tuple of numeric columns per fold. Rows with a null in
    their fold's features go to the fold's basic model, which uses
    ``basic_features`` instead; leave that empty to train no basic models. With
    ``label_tables`` the labels of ``categorical`` are kept in tables and joined, for
    columns with more labels than a driver holds.
    """

    target: str
    date: str
    ids: tuple[str, ...]
    features: tuple[tuple[str, ...], ...]
    basic_features: tuple[tuple[str, ...], ...] = ()
    cyclical: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    label_tables: bool = False

    def __post_init__(self):
        if self.basic_features and len(self.basic_features) != len(self.features):
            raise ValueError("basic_features needs one entry per fold")

    @property
    def prediction(self) -> str:
        return self.target + PREDICTION

    @property
    def folds(self) -> range:
        return range(len(self.features))

    @property
    def variants(self) -> tuple[str, ...]:
        return (FULL, BASIC) if self.basic_features else (FULL,)

    def numeric(self, fold: int, variant: str = FULL) -> list[str]:
        """Numeric model inputs of a fold: its own columns, then sines, then cosines."""
        own = (self.basic_features if variant == BASIC else self.features)[fold]
        return [*own, *(c + SIN for c in self.cyclical), *(c + COS for c in self.cyclical)]

    def inputs(self) -> list[str]:
        """Every numeric or categorical input of any fold, once."""
        columns = [c for v in self.variants for f in self.folds for c in self.numeric(f, v)]
        return list(dict.fromkeys([*columns, *self.categorical]))


@dataclass(frozen=True)
class ForestParams:
    num_trees: int = 20
    max_depth: int = 5
    max_features: str | int | float = "auto"
    subsampling_rate: float = 1.0
    min_samples_leaf: int = 1
    seed: int = SAMPLE_SEED
    max_memory_mb: int = 256
    cache_node_ids: bool = False
    bootstrap: bool = True
