"""Decode and route messages with Spark: one transformation for batch and streaming."""

from sluicegate.config import RouterConfig
from sluicegate.operators.rules import Rules
from sluicegate.operators.schemas import Registry
from sluicegate.plans.route import route

__all__ = ["Registry", "RouterConfig", "Rules", "route"]
