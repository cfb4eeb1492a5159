"""Leaderboards and the champion rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _usable(score: str):
    return F.nanvl(F.col(score).cast("double"), F.lit(None))


def leaderboard(scores: DataFrame, score: str = "score", order: str = "ord") -> DataFrame:
    """Ranked candidates, best first; NaN scores last; equal scores in canonical order. One row per candidate."""
    window = Window.orderBy(F.desc_nulls_last(_usable(score)), F.col(order))
    return scores.withColumn("rank", F.row_number().over(window))


def select_champion(scores: DataFrame, score: str = "r2_mean", order: str = "ord") -> DataFrame:
    """The row with the highest score; NaN never wins and ties go to the first in canonical order."""
    return scores.filter(_usable(score).isNotNull()).orderBy(F.desc(score), order).limit(1)


def champion_row(scores: DataFrame, score: str = "r2_mean", order: str = "ord"):
    row = select_champion(scores, score, order).first()
    if row is None:
        raise RuntimeError("could not determine a champion: no candidate has a score")
    return row
