"""All checked queries with the SQL they are checked against."""

from hearthline.catalog import house, learning, tables  # noqa: F401  (they register their queries)
from hearthline.catalog.base import ORACLES, QUERIES  # noqa: F401
