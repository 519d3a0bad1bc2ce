"""tidemark: the data side of a tabular-ML lifecycle as Spark DataFrame jobs.

Every public operator is a plain function ``DataFrame (+ arguments) -> DataFrame``.
Sub-packages:

* ``sources``   - scans, snapshots, change feeds and idempotent sinks
* ``functions`` - column-expression builders (cleaning, hashing, JSON schemas)
* ``operators`` - cleaning, profiling, sampling, payload parsing, metrics,
                  monitoring, synthesis, feature coding and MLlib training
* ``plans``     - scale helpers (checked broadcast, distributed running totals)
                  and the registered stand-in queries over the test tables
* ``streaming`` - Structured Streaming versions of the monitor refresh
"""

__version__ = "0.1.0"
