"""A statistic as a user would write one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronopix.model import Measurement
from chronopix.operators.base import Statistic


class CountWet(Statistic):
    """How often the first band says wet."""

    incremental = True

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        return [Measurement("wet", "int16", -1)]

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        return {"wet": F.count_if(F.col(f"`{inputs[0].name}`") == 128)}
