"""Catalogue of queries over the benchmark tables, one per operator family.

The benchmark tables hold no match data, so each query feeds the model
functions with stand-in columns (a line item plays a delivery, an order a
match, a part name a venue, ...); the model code itself is the same.
"""

from matchlake.plans.catalogue import io_q, json_q, marts_q, models_q, order_q, quality_q  # noqa: F401
from matchlake.plans.catalogue.registry import ORACLE_SQL, QUERIES, table

__all__ = ["ORACLE_SQL", "QUERIES", "table"]
