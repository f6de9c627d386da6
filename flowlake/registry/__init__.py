"""Every operator as a query on the given tables, with SQL to check it where SQL can."""

from flowlake.registry import (  # noqa: F401
    drift_checks,
    kpi_checks,
    mart_checks,
    model_checks,
    model_facts,
    quality_checks,
    relational_checks,
    stream_checks,
)
from flowlake.registry.core import ORACLES, QUERIES  # noqa: F401
