"""Whole flows: the software inventory and the daily job."""

from nestflow.plans.inventory import INVENTORY_STEPS, inventory_schema
from nestflow.plans.job import run_job

__all__ = ["INVENTORY_STEPS", "inventory_schema", "run_job"]
