"""Figures of stages, taken while they are written."""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from gleaner.functions.names import column
from gleaner.session import store


class StageMetrics:
    """Rows, sums and seconds of each stage that goes through :meth:`store`.

    Sums are observed in the job that writes the stage, so nothing is read twice.
    Stages keep their order; a name used again is a stage of its own.
    """

    def __init__(self) -> None:
        self._rows: list[tuple[int, str, str, float]] = []

    def store(self, df: DataFrame, stage: str, **sums: Column) -> DataFrame:
        """Store ``df`` as :func:`gleaner.session.store` does and note its rows, the ``sums`` and the time."""
        number = 1 + max((r[0] for r in self._rows), default=-1)
        seen = Observation(f"{stage}-{number}")
        begun = time.perf_counter()
        figures = [F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in sums.items()]
        out = store(df.observe(seen, F.count(F.lit(1)).alias("rows"), *figures), stage)
        seconds = time.perf_counter() - begun
        got = seen.get
        self._rows += [(number, stage, name, float(got[name])) for name in ("rows", *sums)]
        self._rows.append((number, stage, "seconds", seconds))
        return out

    def rows(self) -> list[tuple[int, str, str, float]]:
        return list(self._rows)

    def table(self, spark: SparkSession) -> DataFrame:
        """``(number, stage, metric, value)``, as :func:`gleaner.operators.layout.stage_metrics` summarises it."""
        return spark.createDataFrame(self._rows, "number int, stage string, metric string, value double")

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON document: ``[{"stage": …, "rows": …, "seconds": …}, …]``."""
        stages: dict[int, dict] = {}
        for number, stage, metric, value in self._rows:
            stages.setdefault(number, {"stage": stage})[metric] = value
        saved = json.dumps([stages[n] for n in sorted(stages)])
        spark.createDataFrame([(saved,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "StageMetrics":
        out = cls()
        for number, stage in enumerate(json.loads(spark.read.option("wholetext", True).text(path).first()[0])):
            name = stage.pop("stage")
            out._rows += [(number, name, metric, float(value)) for metric, value in stage.items()]
        return out


def bytes_of(name: str) -> Column:
    """UTF-8 bytes of a text column; a null has none."""
    return F.coalesce(F.octet_length(column(name)), F.lit(0)).cast("bigint")
