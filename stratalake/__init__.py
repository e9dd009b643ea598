"""Spark-native bronze / silver / gold tables for claims data."""

from stratalake.lake import Lake
from stratalake.schemas import TABLES, TableSpec
from stratalake.session import build_session, run_folder

__all__ = ["Lake", "TABLES", "TableSpec", "build_session", "run_folder"]
