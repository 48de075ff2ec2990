"""All registered queries."""

from millrace.catalog import batch, endpoints, streams, userdefined  # noqa: F401
from millrace.catalog.registry import ORACLES, QUERIES  # noqa: F401
