"""All registered queries."""

from . import changes, commands, refined, scalars, streams, tables  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
