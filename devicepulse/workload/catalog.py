"""Importing this module registers every query."""

from devicepulse.workload import columns, histories, modelling, profiles, storage
from devicepulse.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "columns", "histories", "modelling", "profiles", "storage"]
