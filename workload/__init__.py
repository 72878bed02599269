"""Named queries over the given tables."""

from . import depth, evaluate, features, groups, models, prep  # noqa: F401
from .base import ORACLES, QUERIES
from .models import flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]
