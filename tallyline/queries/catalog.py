"""All registered queries: importing the modules below fills the registry."""

from __future__ import annotations

from tallyline.queries import base
from tallyline.queries import gold, reconcile, quality, analytics, scoring, operators, reports  # noqa: F401


def queries():
    return base.all_queries()


def oracles():
    return base.all_oracles()
