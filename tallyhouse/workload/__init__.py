"""The library run on the given test tables, with a SQL counterpart for every query."""

from tallyhouse.workload import landing, model_checks, models, operators, reruns  # noqa: F401
from tallyhouse.workload.registry import REGISTRY

__all__ = ["REGISTRY"]
