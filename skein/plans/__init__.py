"""Queries over the driver tables, each next to its SQL."""

from skein.plans import (article_queries, file_queries, graph_queries, keyed_queries,  # noqa: F401
                         learn_queries, stream_queries, text_queries)
from skein.plans.registry import ORACLES, QUERIES  # noqa: F401
