"""Data preparation on Spark: composable DataFrame operators and ready-made jobs."""

from spindrift.session import get_session

__all__ = ["get_session"]
