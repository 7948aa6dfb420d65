"""cartwise: retail analytics for an online store, written as Spark DataFrame plans.

Layout:
  sources/    table loading (store schema, JDBC, benchmark adapter), sinks, co-located layout
  functions/  column-level helpers: calendar windows, ages, states, dense indexes
  operators/  the user-level jobs (overviews, rankings, recommenders, segments, forecasts)
  plans/      the registered query catalog, its DuckDB oracle SQL, the job runner
"""

from cartwise.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
