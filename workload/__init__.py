"""Queries over the driver's tables, each next to the SQL that must give the same rows."""

from workload.registry import ORACLES, QUERIES

import workload.rule_queries  # noqa: E402,F401
import workload.row_queries  # noqa: E402,F401
import workload.report_queries  # noqa: E402,F401
import workload.contract_queries  # noqa: E402,F401
import workload.source_queries  # noqa: E402,F401

__all__ = ["ORACLES", "QUERIES"]
