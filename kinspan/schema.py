"""Record layouts and the tunable constants of the linkage pipeline."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
TRUTH_COLUMNS = ["source1_entity_id", "matched_entity_ids"]
CANDIDATE_COLUMNS = ["source1_entity_id", "candidate_entity_ids"]
PAIR = ["source1_entity_id", "candidate_entity_id"]

SOURCE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in SOURCE_COLUMNS])
TRUTH_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in TRUTH_COLUMNS])


@dataclass(frozen=True)
class BlockingConfig:
    """Limits and weights of candidate generation."""

    min_token: int = 3
    prefix: int = 4
    max_posting: int = 500  # records of one side that a key may stand in
    max_product: int = 50_000  # pairs that a key may give
    max_candidates: int = 10  # kept for each S1 record, over both other sources
    weights: dict = field(default_factory=lambda: {"addr_digit": 3.0, "name_token": 1.5, "name_prefix": 1.0, "addr_token": 1.0})


@dataclass(frozen=True)
class ThresholdConfig:
    """A pair is accepted at accept_threshold; a record gets pairs only if its best reaches singleton_abstain_threshold."""

    accept_threshold: float = 0.5
    singleton_abstain_threshold: float = 0.5


VAL_FRACTION = 0.15
SEED = 42
NAME_NGRAM = 3


@dataclass(frozen=True)
class Paths:
    """Where inputs, outputs and experiments lie: arguments, else KINSPAN_* in the environment, else folders below root."""

    root: str = "."
    data: str | None = None
    output: str | None = None
    experiments: str | None = None

    def _at(self, given: str | None, variable: str, default: str) -> Path:
        return Path(given or os.environ.get(variable) or Path(self.root) / default)

    @property
    def data_root(self) -> Path:
        return self._at(self.data, "KINSPAN_DATA_ROOT", "dataset")

    @property
    def output_root(self) -> Path:
        return self._at(self.output, "KINSPAN_OUTPUT_ROOT", "output")

    @property
    def experiments_root(self) -> Path:
        return self._at(self.experiments, "KINSPAN_EXPERIMENTS_ROOT", "experiments")

    def source(self, split: str, number: int) -> Path:
        return self.data_root / split / f"{split}_source{number}.tsv"

    def truth(self) -> Path:
        return self.data_root / "train" / "train_ground_truth.tsv"

    def discover(self, split: str) -> dict[str, Path]:
        """The source files of a split that exist, by name: at their usual place or, failing that, the first of that name anywhere below the data folder; raises where one is missing."""
        found = {}
        for i in (1, 2, 3):
            usual = self.source(split, i)
            found[f"source{i}"] = usual if usual.exists() else min(self.data_root.rglob(usual.name), default=usual)
        missing = [str(p) for p in found.values() if not p.exists()]
        if missing:
            raise FileNotFoundError(", ".join(missing))
        return found


def source_of(entity_id: Column) -> Column:
    """The source, S1, S2 or S3, that an id's prefix names."""
    return F.substring_index(entity_id, "-", 1)
