"""All registered queries."""

from laminae.plans import q_core, q_flow, q_gold, q_ops, q_serve, q_state, q_stream  # noqa: F401
from laminae.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
