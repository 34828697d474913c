"""The registered queries. Importing the modules fills the registry."""

from ledgerlode.catalogue import (  # noqa: F401
    batches, business, checks, gold, history, layers, reports, tables, whole,
)
from ledgerlode.catalogue.registry import QUERIES, SQL  # noqa: F401
