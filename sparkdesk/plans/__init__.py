"""Wiring of the operators onto the driver tables (see SURVEY §7.3), plus the
equivalent DuckDB SQL used as the correctness oracle."""

from sparkdesk.plans.registry import all_queries, all_oracle_sql

__all__ = ["all_queries", "all_oracle_sql"]
