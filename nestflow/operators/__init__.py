"""The flatten steps: a list of ``{operation: ...}`` dicts folded over a DataFrame."""

from nestflow.operators.steps import apply_steps
from nestflow.operators.validate import StepError, check_steps

__all__ = ["StepError", "apply_steps", "check_steps"]
