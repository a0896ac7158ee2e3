"""Layered batch analytics on Spark: raw yearly files, history tables, per-owner metrics."""

from layerloom.config import Config, build_session

__all__ = ["Config", "build_session"]
