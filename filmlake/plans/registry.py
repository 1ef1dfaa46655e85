"""All registered queries: name -> (Spark query, SQL twin or None)."""

from . import (
    list_queries,
    model_queries,
    source_queries,
    stat_queries,
    table_queries,
    text_queries,
)

REGISTRY = {
    **table_queries.QUERIES,
    **stat_queries.QUERIES,
    **list_queries.QUERIES,
    **text_queries.QUERIES,
    **model_queries.QUERIES,
    **source_queries.QUERIES,
}
