"""Spans of a number line as column conditions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiltwatch.config import Span


def in_span(column: str | Column, span: Span) -> Column:
    """True where the value lies in ``span``. NULL lies in none."""
    value = F.col(column) if isinstance(column, str) else column
    if span.at_least is not None and span.at_most is not None:
        return value.between(span.at_least, span.at_most)
    condition = value.isNotNull()
    if span.at_least is not None:
        condition &= value >= span.at_least
    if span.above is not None:
        condition &= value > span.above
    if span.at_most is not None:
        condition &= value <= span.at_most
    if span.below is not None:
        condition &= value < span.below
    return condition


def span_conditions(column: str | Column, spans: Sequence[Span]) -> dict[str, Column]:
    return {span.name: in_span(column, span) for span in spans}
