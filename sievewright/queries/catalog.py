"""All registered queries; importing the modules fills the registry."""

from sievewright.queries import masters, modelling, profiles, quality, runs, statistics, texts, timelines  # noqa: F401
from sievewright.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
