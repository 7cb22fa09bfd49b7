"""Imports every module that registers queries."""

from . import cells, documentation, expressions, flows, ingest, matching, physical, reports, semantic  # noqa: F401
