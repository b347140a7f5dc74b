"""Flatten large folders of nested XML into Parquet tables with Spark."""

from nestflow.operators import StepError, apply_steps, check_steps

__all__ = ["StepError", "apply_steps", "check_steps"]
