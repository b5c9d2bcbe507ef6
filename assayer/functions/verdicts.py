"""A judge's reply to a verdict: the last line must be one of the words asked for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import last_line


def rubric_met(reply: Column) -> Column:
    """true for MET, false for NOT_MET, null for anything else."""
    word = last_line(reply)
    return F.when(word == "MET", True).when(word == "NOT_MET", False)


def pairwise_choice(reply: Column) -> Column:
    word = last_line(reply)
    return F.when(word.isin("A", "B", "TIE"), word)


def pairwise_score(choice: Column, product_is_a: Column) -> Column:
    """1, 0.5 or 0 from the product's view; null without a choice."""
    return F.when(choice == "TIE", 0.5).when(choice.isin("A", "B"), F.when((choice == "A") == product_is_a, 1.0).otherwise(0.0))
