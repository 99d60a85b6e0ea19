"""Interval labels and the scalar expressions of the feature stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Interval edges, and one label more than there are edges.
FAMILY_EDGES = (1, 4)
FAMILY_LABELS = ("loner", "small", "large")
FARE_EDGES = (4, 10, 20, 45)
FARE_LABELS = ("Very_low", "low", "mid", "high", "very_high")
CABIN_EDGES = (16, 27, 38, 47, 53, 54, 116)
CABIN_LABELS = ("G", "F", "T", "A", "E", "D", "C", "B")


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def bucketize(
    col: Column | str, edges: Sequence[float], labels: Sequence[str], right: bool = True
) -> Column:
    """Label of the interval that holds the value; a null value has a null label.

    ``right`` puts an edge into the interval below it, otherwise it opens the one above.
    NaN is above every edge.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError(f"{len(edges)} edges need {len(edges) + 1} labels, not {len(labels)}")
    if any(low >= high for low, high in zip(edges, edges[1:])):
        raise ValueError(f"edges must rise strictly: {list(edges)}")
    value = _column(col)
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, name in zip(edges, labels):
        label = label.when(value <= edge if right else value < edge, name)
    return label.otherwise(labels[-1])


def family_size(siblings: Column | str, parents: Column | str) -> Column:
    """Relatives on board plus the person, as double."""
    return (_column(siblings) + _column(parents) + 1).cast("double")


def family_group(size: Column | str) -> Column:
    return bucketize(size, FAMILY_EDGES, FAMILY_LABELS)


def fare_group(fare: Column | str) -> Column:
    """Fare band. Text is read as a number first; text that is no number gives null."""
    return bucketize(_column(fare).try_cast("double"), FARE_EDGES, FARE_LABELS)


def cabin_estimator(amount: Column | str) -> Column:
    """Cabin letter guessed from an amount; an edge belongs to the band above it."""
    return bucketize(amount, CABIN_EDGES, CABIN_LABELS, right=False)
