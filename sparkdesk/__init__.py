"""sparkdesk: reusable PySpark data jobs written as DataFrame -> DataFrame functions.

Sub-packages:
  sources    readers (parquet, CSV, ORC, text lines, paged JSON, day partitions)
  sinks      writers (overwrite, fail-if-exists, append, day partitions, staged refresh)
  functions  column expressions (masking, safe correlation, hash keys, weekday)
  operators  grouped reports, line reports, data quality, vault/anchor loading, marts, ML
  plans      the wiring of operators onto the driver tables, plus the DuckDB oracle SQL
  streaming  the incremental (file-landing) variant of the line report
"""

__version__ = "0.1.0"
