"""The registered queries and the SQL that checks them."""

from tidewheel.plans import data, forecasting, prompting, scaling, searching, training
from tidewheel.plans.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "data",
    "forecasting",
    "prompting",
    "scaling",
    "searching",
    "training",
]
