"""A deterministic scorer for tests. Its outputs are small integers, so that ties occur."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boardpulse.operators.scoring import column_scorer


def stand_in(text: Column) -> Column:
    others = F.length(F.replace(text, F.lit("e"), F.lit("")))
    return F.array(F.length(text) % 5, (F.length(text) - others) % 5, F.lit(2))


stand_in_scorer = column_scorer(stand_in)
