"""Reusable distributed operators."""

from cartwheel.operators import calendar, pairs, ranking

__all__ = ["calendar", "pairs", "ranking"]
