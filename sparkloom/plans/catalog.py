"""All registered queries; importing this module registers them."""

from sparkloom.plans import (  # noqa: F401
    collection_queries,
    join_queries,
    keyed_queries,
    matrix_queries,
    null_queries,
    placement_queries,
    row_queries,
    source_queries,
    view_queries,
)
from sparkloom.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
