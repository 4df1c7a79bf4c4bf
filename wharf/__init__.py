"""wharf — warehouse and lake operators on PySpark DataFrames and Spark SQL.

Modules:

* ``session`` — session defaults, the shared checkpoint/scratch folder, sizing.
* ``schemas`` — declared schemas of the inputs and outputs.
* ``sources`` — file, catalog and driver-table readers; conforming stand-ins.
* ``sinks`` — writes and table definitions.
* ``functions`` — scalar expressions as built-in Column functions.
* ``operators`` — joins, aggregates, windows, upsert, keys, sampling, quality.
* ``plans`` — the jobs: star builds, lake chain, serving tables, analytics,
  layout studies, question bank.
* ``streaming`` — incremental (bookmark-style) runs.
* ``registry`` — every registered query with its SQL oracle.
"""

__version__ = "0.1.0"
