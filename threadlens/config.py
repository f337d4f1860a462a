"""Knobs shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """One immutable bag of settings; operators take what they need as arguments.

    ``rows_per_split`` is the number of rows of one join key that a single task
    may get before the key is split over several tasks.
    """

    brand: str
    seed: int = 42
    per_intent: int = 25
    calibration_rows: int = 40
    cluster_rows: int = 3000
    silhouette_rows: int = 1000
    k_candidates: tuple[int, ...] = (6, 8, 10, 12)
    rows_per_split: int = 500_000
