"""hackney — taxi-trip analytics expressed as Spark DataFrame plans.

* ``hackney.plans.queries``  — the query catalogue (pure DataFrame -> DataFrame)
* ``hackney.plans.registry`` — ``(spark, sf_dir)`` entry points over the test tables
* ``hackney.sources``        — CSV / Parquet / raw-text readers and writers
* ``hackney.operators``      — checked lookups, arg-max, top-k
* ``hackney.functions``      — Column expressions (haversine, time, exact sums)
* ``hackney.streaming``      — the aggregates over a folder of arriving files
* ``hackney.run``            — command-line runner

The caller owns the session and the action; nothing here collects results.
"""

__version__ = "0.1.0"
