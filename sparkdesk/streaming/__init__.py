"""Incremental (file-landing) variants of the batch jobs."""

from sparkdesk.streaming.line_report import run_incremental_tip_report

__all__ = ["run_incremental_tip_report"]
