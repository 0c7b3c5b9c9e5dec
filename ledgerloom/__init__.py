"""ledgerloom: monthly retail sales analytics on Spark DataFrames.

Sub-packages:
  sources    -- file readers (CSV, multi-line JSON) and table adapters
  functions  -- scalar column functions
  operators  -- explode, reject split, keep-first, per-order, report
  plans      -- the composed monthly chain, quality counters, staging
  sinks      -- CSV / table writers
  streaming  -- incremental landing of daily order files
"""

__version__ = "0.1.0"
