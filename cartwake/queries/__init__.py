"""Named queries over the test tables and their SQL counterparts."""

from cartwake.queries import batch, ingest, learn, online, serve, shop, stream  # noqa: F401
from cartwake.queries import split  # noqa: F401  registers what the others have
from cartwake.queries.base import ORACLES, QUERIES, Tables

__all__ = ["ORACLES", "QUERIES", "Tables"]
