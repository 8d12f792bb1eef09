"""A small star-schema cube: a fact joined to its dimensions, a calendar,
named dimension columns (``Table[column]``) and named measures."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class Measure:
    name: str          # the cube's measure name, e.g. sell_qty
    caption: str       # the result caption the measure is reported under
    value: Column      # what is summed, over the cube's base columns


@dataclass
class CubeModel:
    """``base`` holds one row per fact row, already joined to every
    dimension: qualified dimension columns, the measure inputs, the calendar
    date column and the ISO ``year_num`` / ``week_num`` stamps."""
    base: DataFrame
    date_col: str
    dimensions: list[str]
    measures: list[Measure]
    filters: dict[str, str] = field(default_factory=dict)  # filter name -> dimension column

    def measure(self, name: str) -> Measure:
        for m in self.measures:
            if m.name == name:
                return m
        raise KeyError(name)
