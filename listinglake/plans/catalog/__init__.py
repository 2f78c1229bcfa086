"""All registered queries and their SQL."""

from listinglake.plans.catalog import dedupe, gold, increments, lake, texts  # noqa: F401
from listinglake.plans.catalog.registry import ORACLES, QUERIES  # noqa: F401
