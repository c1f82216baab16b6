"""All registered queries."""

from rankloom.plans import families, models, monitoring, serving, streams, tables  # noqa: F401
from rankloom.plans.registry import ORACLES, QUERIES  # noqa: F401
