"""Checks on a step list, made before any DataFrame is touched."""

from __future__ import annotations

from collections.abc import Collection, Sequence

# operation: (required keys, further keys)
OPERATIONS = {
    "select": ({"columns"}, {"missing"}),
    "explode": ({"column", "alias"}, {"keep", "outer"}),
    "filter": ({"condition"}, set()),
    "join": ({"on"}, {"with", "how", "salt", "hot_share", "least_hot"}),
    "groupBy": ({"columns"}, set()),
    "agg": ({"aggregations"}, set()),
    "orderBy": ({"columns"}, set()),
    "union": (set(), {"with", "by_name"}),
    "distinct": (set(), set()),
    "withColumn": ({"column"}, {"value", "func"}),
}


class StepError(ValueError):
    """A step that cannot be run, with its number and operation."""

    def __init__(self, number: int, operation: object, problem: str):
        super().__init__(f"step {number} ({operation}): {problem}")


# Rows of the other input belong to no file: for each file alone they would be needed again.
NOT_PER_FILE = {"right", "rightouter", "outer", "full", "fullouter"}


def check_steps(
    steps: Sequence[dict], inputs: Collection[str] = (), in_job: bool = False
) -> None:
    """Raise ``StepError`` for the first step that is malformed.

    ``in_job`` also refuses what cannot be done for many files at once as for each alone.
    """
    previous = None
    for number, step in enumerate(steps, start=1):
        operation = step.get("operation") if isinstance(step, dict) else step
        if not isinstance(step, dict) or operation not in OPERATIONS:
            raise StepError(number, operation, f"unknown; known are {sorted(OPERATIONS)}")
        required, further = OPERATIONS[operation]
        if absent := required - step.keys():
            raise StepError(number, operation, f"needs {sorted(absent)}")
        if surplus := step.keys() - required - further - {"operation"}:
            raise StepError(number, operation, f"does not take {sorted(surplus)}")
        if previous == "groupBy" and operation != "agg":
            raise StepError(number, operation, "a groupBy must be followed by agg")
        if operation in ("join", "union"):
            _check_input(number, operation, step, inputs)
            kind = str(step.get("how", "")).lower().replace("_", "")
            if in_job and (operation == "union" or kind in NOT_PER_FILE):
                problem = f"{kind or operation} adds rows that are of no file"
                raise StepError(number, operation, f"{problem}, which a job cannot place")
        previous = operation
    if previous == "groupBy":
        raise StepError(len(steps), "groupBy", "must be followed by agg")


def _check_input(number: int, operation: str, step: dict, inputs: Collection[str]) -> None:
    name = step.get("with")
    if name is None and len(inputs) != 1:
        raise StepError(number, operation, f"say with which input; given are {sorted(inputs)}")
    if name is not None and name not in inputs:
        raise StepError(number, operation, f"no input {name!r}; given are {sorted(inputs)}")
