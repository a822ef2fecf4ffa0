"""Media inventory jobs on Spark DataFrames."""

from cliptrack.plans.workflow import Workflow
from cliptrack.session import configured
from cliptrack.sources.inventory import ConcurrentCommit, Inventory

__all__ = ["ConcurrentCommit", "Inventory", "Workflow", "configured"]
