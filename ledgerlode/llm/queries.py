"""Importing this module fills the registry of the package."""

from ledgerlode.llm import (  # noqa: F401
    queries_mix_shard, queries_pairs, queries_repeats, queries_text, queries_tokens,
)
from ledgerlode.llm.registry import QUERIES, SQL  # noqa: F401
