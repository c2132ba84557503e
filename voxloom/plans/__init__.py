"""Plans: the registered queries and their SQL."""

from voxloom.plans import array_queries, manifest_queries, ordered_queries, sequence_queries, stream_queries, text_queries, wer_queries  # noqa: F401, E501  (they register)
from voxloom.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
