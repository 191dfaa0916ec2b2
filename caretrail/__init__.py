"""caretrail: customer-contact attribution analytics as Spark DataFrame transforms.

Sub-packages:
  sources    -- table readers and declared schemas
  functions  -- column expressions (ids, phones, text flags, time helpers, rulesets)
  operators  -- DataFrame -> DataFrame operators (sessions, as-of, first touch, matching, ...)
  plans      -- whole reports composed from the operators, plus the driver-table analog queries
  streaming  -- incremental session rollups with Structured Streaming
"""

__version__ = "0.1.0"
