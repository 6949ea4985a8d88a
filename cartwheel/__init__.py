"""cartwheel: retail analytics marts, metric queries and checks as Spark jobs.

Layout:
  sources/    source schemas, parquet loader, driver-fixture adapter
  functions/  Column-level helpers (safe divide, whole-unit time differences, calendar)
  operators/  reusable distributed operators (distributed ntile/row number,
              co-occurrence pairs, calendar grids)
  plans/      the models (staging -> marts -> semantic views), metric queries,
              ad-hoc analyses, data-quality checks and the full build job
"""

DEFAULT_AS_OF = "2025-12-31"
