"""All registered queries."""

from marquee.plans import (  # noqa: F401  (importing registers)
    queries_event,
    queries_page,
    queries_scalar,
    queries_source,
    queries_table,
)
from marquee.plans.catalog import ORACLES, QUERIES  # noqa: F401
