"""DuckDB oracle SQL for the registered queries (the correctness gate)."""

from cartwheel.oracle.oracles import ORACLES

__all__ = ["ORACLES"]
