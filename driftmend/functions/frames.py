"""Stacking many small results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns in the same order.

    Joined up in halves: each union is analysed when it is made, so a chain over the tables of a large
    schema would be analysed over and over.
    """
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return stacked(frames[:middle]).union(stacked(frames[middle:]))
