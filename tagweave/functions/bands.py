"""Banded scores: a number is mapped to the score of the band it falls into."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


class Band(NamedTuple):
    """Score of the values from ``low`` to ``high``; ``None`` leaves that end open."""

    score: float
    low: float | None
    high: float | None
    below_high: bool = False  # True: ``high`` itself is outside

    def holds(self, value: Column) -> Column:
        inside = value.isNotNull()
        if self.low is not None:
            inside = value >= self.low
        if self.high is not None:
            upper = value < self.high if self.below_high else value <= self.high
            inside = upper if self.low is None else inside & upper
        return inside


def band_score(value: Column, bands: list[Band]) -> Column:
    """Score of the first band that holds ``value``; null when none does."""
    score = F.when(bands[0].holds(value), F.lit(bands[0].score))
    for band in bands[1:]:
        score = score.when(band.holds(value), F.lit(band.score))
    return score


def rising(*starts: float) -> list[Band]:
    """Contiguous bands where more is better: scores 2, 3, … begin at ``starts``; 1 below."""
    edges = [None, *starts, None]
    return [
        Band(float(i + 1), edges[i], edges[i + 1], below_high=True)
        for i in reversed(range(len(starts) + 1))
    ]


def falling(*ends: float) -> list[Band]:
    """Contiguous bands where less is better: the best score ends at the first of ``ends``; 1 above."""
    top = len(ends) + 1
    bands = [Band(float(top - i), None, end) for i, end in enumerate(ends)]
    return [*bands, Band(1.0, None, None)]


# Score bands by customer value (days, orders, money).
RFM_AS_CODED = {
    "recency": [
        Band(5.0, 1, 3), Band(4.0, 4, 6), Band(3.0, 7, 9), Band(2.0, 10, 15), Band(1.0, 16, None),
    ],
    "frequency": [
        Band(1.0, 1, 49), Band(2.0, 50, 99), Band(3.0, 100, 149), Band(4.0, 150, 199),
        Band(5.0, 200, None),
    ],
    "monetary": [
        Band(1.0, None, 10000, below_high=True), Band(2.0, 10000, 49999), Band(3.0, 50000, 99999),
        Band(4.0, 100000, 199999), Band(5.0, 200000, None),
    ],
}

# Score bands by activity (days, page views, distinct pages).
RFE_AS_CODED = {
    "recency": [
        Band(5.0, 1, 15), Band(4.0, 16, 30), Band(3.0, 31, 45), Band(2.0, 46, 60),
        Band(1.0, 61, None),
    ],
    "frequency": [
        Band(1.0, None, 99), Band(2.0, 100, 199), Band(3.0, 200, 299), Band(4.0, 300, 399),
        Band(5.0, 400, None),
    ],
    "engagements": [
        Band(1.0, None, 49, below_high=True), Band(2.0, 50, 149), Band(3.0, 150, 199),
        Band(4.0, 200, 249), Band(5.0, 250, None),
    ],
}

# The same tables with their gaps closed: every known value has a score.
RFM_DOCUMENTED = {
    "recency": falling(3, 6, 9, 15),
    "frequency": rising(50, 100, 150, 200),
    "monetary": rising(10000, 50000, 100000, 200000),
}
RFE_DOCUMENTED = {
    "recency": falling(15, 30, 45, 60),
    "frequency": rising(100, 200, 300, 400),
    "engagements": rising(50, 150, 200, 250),
}

Preset = dict[str, list[Band]]


def score_column(measure: str) -> str:
    """Name of the score of a measure: first letter and ``_score``."""
    return f"{measure[0]}_score"


def score_columns(preset: Preset) -> list[str]:
    return [score_column(measure) for measure in preset]


def add_scores(df: DataFrame, preset: Preset, user: str = "userId") -> DataFrame:
    """``user`` and one score per measure of ``preset``."""
    return df.select(
        user,
        *[band_score(F.col(m), bands).alias(score_column(m)) for m, bands in preset.items()],
    )
