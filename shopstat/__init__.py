"""shopstat — sales analytics expressed as Spark DataFrame plans.

Layout:

* ``sources``   — scans, sinks, the sales data model over the driver tables.
* ``functions`` — Column-level building blocks (revenue, month bucket,
  counter-based random columns, formatting).
* ``operators`` — DataFrame -> DataFrame operators: joins, aggregates,
  distributed ranking / prefix sums, reports, comparisons, skewed allocation.
* ``plans``     — jobs composed from operators: the report-writing job, the
  table generator, the format comparison, the stored-dataset report.
* ``streaming`` — intentionally empty (the reference has no streaming work).

Every operator takes DataFrames (and plain parameters) and returns a
DataFrame; nothing is collected to the driver except scalars and bounded
metadata.
"""

__version__ = "0.1.0"
