"""cinespark: film-catalogue analytics written with Spark's DataFrame API.

Layers:
  sources/    typed readers for the tab-separated tables, fixtures derived
              from the test star schema, source checks, serving scans, sinks
  functions/  column expressions (null sentinel, decade, age, genre items, ...)
  operators/  reusable distributed building blocks (dense rank on distinct
              values, group counts joined back, one-hot pivot, paging)
  plans/      the data jobs: marts, ML features, dashboard facet queries
"""

from cinespark.plans.catalog import FilmTables

__all__ = ["FilmTables"]
