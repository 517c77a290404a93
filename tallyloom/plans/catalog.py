"""Imports every query module, so that the registry is complete."""

from tallyloom.plans import q_behaviour, q_evaluate, q_linkage, q_models, q_rows, q_sources, q_streams, q_web  # noqa: F401
from tallyloom.plans.registry import ORACLES, QUERIES  # noqa: F401
