"""Named queries over the driver's tables, each beside its SQL oracle."""

from . import aggregates, checks, citations, drafts, evidence, extract, filters, formats, forum, guards, merges, pages, pools, ranks, relations, rules, search, stores, texts  # noqa: F401
from .registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
