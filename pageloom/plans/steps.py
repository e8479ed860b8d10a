"""Hooks: user functions from DataFrame to DataFrame, applied in order."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def apply_steps(df: DataFrame, steps: Iterable[tuple[int, Step]]) -> DataFrame:
    """Run the steps by ascending order number; equal numbers keep their given order."""
    for _, step in sorted(steps, key=lambda s: s[0]):
        df = df.transform(step)
    return df


def identity(df: DataFrame) -> DataFrame:
    return df
