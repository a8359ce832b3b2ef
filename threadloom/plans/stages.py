"""Pluggable processing: an ordered map of stages, each a DataFrame function."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame

from threadloom.operators.validate import Check, clean_validate

Stage = Callable[[DataFrame], DataFrame]


def run_stages(df: DataFrame, stages: Mapping[Stage, int] | Iterable[tuple[Stage, int]]) -> DataFrame:
    """Apply the stages by rising priority. No stages leave the rows as they are.

    A stage drops a row by filtering it or, to keep it countable, by giving it a reject reason.
    """
    pairs = stages.items() if isinstance(stages, Mapping) else stages
    for stage, _ in sorted(pairs, key=lambda pair: pair[1]):
        df = df.transform(stage)
    return df


def validation_stage(rules: Iterable[Check], zone: str = "UTC") -> Stage:
    rules = tuple(rules)
    return lambda df: clean_validate(df, rules, zone)
