"""Binary search in sorted arrays, as a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_up_to(value: Column, marks: Column, most: int) -> Column:
    """How many of the sorted ``marks``, at most ``most``, are not above the value; NULL for a NULL value.

    Halving steps instead of a comparison with each mark: twelve steps for 4,096 marks.
    """
    steps = [1 << i for i in reversed(range(max(1, most.bit_length())))]

    def step(found: Column, width: Column) -> Column:
        there = F.get(marks, found + width - 1) <= value
        return F.when(F.coalesce(there, F.lit(False)), found + width).otherwise(found)

    places = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)
    return F.when(value.isNotNull(), places)
