"""Layered e-commerce warehouse on Spark: logs and change records in, wide and statistics tables out."""

from tradewake.session import build_session

__all__ = ["build_session"]
