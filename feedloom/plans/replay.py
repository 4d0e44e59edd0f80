"""Bounded replay of changes from the best known resume point."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import first_per_key

# How far checkpoints are trusted, and how far replays reach back.
TRUSTED_HOURS = 24
DISCARD_HOURS = 48
BUFFER_MINUTES = 5
SAFE_START_HOURS = 2


@dataclass(frozen=True)
class ResumePoint:
    tier: str
    at: dt.datetime
    suspect: bool


def resume_point(checkpoints: DataFrame, as_of: dt.datetime) -> ResumePoint:
    """Checkpoint -> last checkpoint minus a buffer -> a safe window before ``as_of``.

    A checkpoint older than 24 hours is used but suspect, one older than 48 hours is not used
    as such.  One aggregated row comes to the driver, so that the point becomes a literal the
    scan can push down.
    """
    row = checkpoints.agg(
        F.max(F.when(F.col("ok") & F.col("token").isNotNull(), F.col("ts"))).alias("token_at"),
        F.max("ts").alias("last_at"),
    ).first()
    if row["token_at"] is not None:
        age = as_of - row["token_at"]
        if age <= dt.timedelta(hours=DISCARD_HOURS):
            return ResumePoint("checkpoint", row["token_at"], age > dt.timedelta(hours=TRUSTED_HOURS))
    if row["last_at"] is not None:
        return ResumePoint("last_checkpoint", row["last_at"] - dt.timedelta(minutes=BUFFER_MINUTES), True)
    return ResumePoint("safe_window", as_of - dt.timedelta(hours=SAFE_START_HOURS), True)


def replay(changes: DataFrame, point: ResumePoint, time: str, key: str, order: list[str]) -> DataFrame:
    """Changes at or after the resume point, each once although replays overlap."""
    return first_per_key(changes.filter(F.col(time) >= F.lit(point.at)), [key], order)
