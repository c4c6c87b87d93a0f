"""Partial aggregates of stream batches, kept as runs of files that a reader merges.

A batch writes what it holds itself, so the bytes written follow the batch and not the table. ``FAN_IN`` runs of a level
are merged into one of the next, so n batches leave about log(n) runs and a row is rewritten about log(n) times.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from merchlens.sources.incremental import committed, entries, remove

FAN_IN = 4


class Runs:
    """Runs below ``path``. ``merge`` puts partial rows together and can be applied to its own result.

    A run's folder is named by its level and the batches in it. A run inside a larger one is left over from a merge and
    is not read; a batch that a run already holds is not added again, so a replayed batch changes nothing. ``path`` and
    the checkpoint that numbers the batches belong together.
    """

    def __init__(
        self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], sort: Sequence[str], fan_in: int = FAN_IN
    ) -> None:
        self.spark, self.path, self.merge, self.sort, self.fan_in = spark, path.rstrip("/"), merge, list(sort), fan_in

    def runs(self) -> list[tuple[int, int, int]]:
        """(level, first batch, last batch) of the runs to read, in order of batches."""
        named = [name.removeprefix("run-").split("-") for name in entries(self.spark, self.path) if name.startswith("run-")]
        found = [tuple(map(int, parts)) for parts in named]
        found = [run for run in found if committed(self.spark, self._folder(run))]
        inside = [a for a in found for b in found if a != b and b[1] <= a[1] and a[2] <= b[2] and b[0] > a[0]]
        return sorted(set(found) - set(inside), key=lambda run: run[1])

    def _folder(self, run: tuple[int, int, int]) -> str:
        return f"{self.path}/run-{run[0]}-{run[1]}-{run[2]}"

    def _write(self, df: DataFrame, run: tuple[int, int, int]) -> None:
        df.sortWithinPartitions(*self.sort).write.mode("overwrite").parquet(self._folder(run))

    def add(self, batch: int, partial: DataFrame) -> None:
        if any(first <= batch <= last for _, first, last in self.runs()):
            return
        self._write(partial, (0, batch, batch))
        self._compact()

    def _compact(self) -> None:
        while True:
            runs = self.runs()
            ready = [level for level in {run[0] for run in runs} if sum(run[0] == level for run in runs) >= self.fan_in]
            if not ready:
                return
            merged = [run for run in runs if run[0] == min(ready)][: self.fan_in]
            self._write(self.merge(self._read(merged)), (min(ready) + 1, merged[0][1], merged[-1][2]))
            for run in merged:
                remove(self.spark, self._folder(run))

    def _read(self, runs: Sequence[tuple[int, int, int]]) -> DataFrame:
        return self.spark.read.parquet(*(self._folder(run) for run in runs))

    def read(self) -> DataFrame:
        """All runs put together."""
        return self.merge(self._read(self.runs()))
