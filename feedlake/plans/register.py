"""Collects every registered query and oracle."""

from __future__ import annotations

from feedlake.plans import queries as _q
from feedlake.plans import oracle_sql as _o


def queries():
    return dict(_q.QUERIES)


def oracle_sql():
    return {k: v for k, v in _o.ORACLES.items() if k in _q.QUERIES}
