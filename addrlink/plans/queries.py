"""Registered queries of the address operators and their SQL."""

from __future__ import annotations

from . import names, spatial

QUERIES: dict = {**spatial.QUERIES, **names.QUERIES}
SQL: dict = {**spatial.SQL, **names.SQL}
