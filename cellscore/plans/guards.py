"""Rules that are checked while rows pass, instead of by a job before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Guard:
    """df as `frame`, whose rows for which `bad` holds are counted as they pass.

    verify, called after the first action that reads the frame to its end (a write, a checkpoint), raises a ValueError
    if there was one; only then does `explain` run, for its text, which may take a job. Before any action it would wait for one.
    A task that runs again may count a row twice, which doesn't matter to a count that must be 0.
    """

    def __init__(self, df: DataFrame, bad: Column, explain: Callable[[], str]):
        self._seen, self._explain = Observation(), explain
        self.frame = df.observe(self._seen, F.count_if(bad).alias("bad"))

    def verify(self) -> None:
        if self._seen.get["bad"]:
            raise ValueError(self._explain())
