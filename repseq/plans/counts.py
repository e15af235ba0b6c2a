"""How many rows each stage of a run had, by sample, counted while they pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class StageCounts:
    """Observations of a run: ``watch`` puts one on a table, and whatever job first computes it fills it in. No job of its own."""

    def __init__(self, samples: Sequence[str]):
        self.samples = list(samples)
        self.watched: dict[str, tuple[Observation, dict[str, tuple]]] = {}

    def watch(self, stage: str, df: DataFrame, statuses: Sequence[str] = ()) -> DataFrame:
        """``df``, counted by its ``sample`` (one of those configured, or null), and by ``status`` where values of it are given."""
        observation = Observation(f"{stage}-{len(self.watched)}")
        keys = [(s, *st) for s in (*self.samples, None) for st in ([(x,) for x in statuses] or [()])]
        labels = {f"n{k}": key for k, key in enumerate(keys)}
        of = lambda key: F.col("sample").eqNullSafe(F.lit(key[0])) & (F.col("status") == key[1] if len(key) > 1 else F.lit(True))
        self.watched[stage] = (observation, labels)
        return df.observe(observation, *(F.count_if(of(key)).alias(label) for label, key in labels.items()))

    def of(self, stage: str) -> dict[tuple, int]:
        """Rows of each (sample) or (sample, status) of a stage that has been computed; zero ones are left out."""
        observation, labels = self.watched[stage]
        return {labels[label]: n for label, n in observation.get.items() if n}

    def lines(self) -> list[str]:
        """One line a stage and sample, for a log."""
        return [f"{stage}: {' '.join(str(x) for x in key if x is not None) or 'no sample'}: {n}" for stage in self.watched for key, n in self.of(stage).items()]
