"""lakemart: shop-event analytics (star schema, SCD2 dimensions, marts,
windowed stream metrics) written as plain Spark DataFrame jobs.

Layout:
  sources/    table / CSV / stream readers and the test-data event mapping
  functions/  column-level helpers (cleaning, rates, segments, calendar)
  operators/  reusable DataFrame operators (lookups, point-in-time join,
              global row index, sessionize, SCD2, quality checks, sinks)
  plans/      table builders: star schema, marts, reports, features
  streaming/  Structured Streaming parse / window / sink jobs
"""

__version__ = "0.1.0"
