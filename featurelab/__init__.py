"""Preparation of tabular training data and choice of features, as Spark jobs."""

from featurelab.operators.splits import Roles, Splits, classify
from featurelab.plans.config import Config
from featurelab.plans.prepare import Preparation, apply, run
from featurelab.plans.state import State, load_state, save_state

__all__ = [
    "Config",
    "Preparation",
    "Roles",
    "Splits",
    "State",
    "apply",
    "classify",
    "load_state",
    "run",
    "save_state",
]
