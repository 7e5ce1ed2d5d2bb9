"""Grades and levels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Lowest score of each tier, best first; below all of them is "churned".
TIERS = [(12, "champion"), (9, "loyal"), (6, "potential"), (4, "at_risk")]
# Multiple of the mean above which an amount gets the level; else "MEDIUM".
OUTSIZED = [(10, "CRITICAL"), (5, "HIGH")]


def activity_tier(score: Column) -> Column:
    grade = F.lit("churned")
    for least, name in reversed(TIERS):
        grade = F.when(score >= least, name).otherwise(grade)
    return grade


def outsized_level(amount: Column, mean: Column) -> Column:
    level = F.lit("MEDIUM")
    for bound, name in reversed(OUTSIZED):
        level = F.when(amount > mean * bound, name).otherwise(level)
    return level
