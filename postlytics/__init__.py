"""postlytics: social-post cleaning and analytics as Spark DataFrame operators.

Modules:

* ``functions``  Column -> Column expressions (count parsing, age bands, names, timestamps)
* ``operators``  DataFrame -> DataFrame operators (cleaning chains, profiles, ranking,
  repeated-key join counts, medians, de-duplication)
* ``sources``    driver-table bindings, landed topics, delimited files, messages, sampling, SQL views
* ``plans``      the analytic questions Q1-Q9, the batch report and the daily batch run
* ``streaming``  message streams, cleaning on streams, append sinks with durable checkpoints
* ``catalog``    registered queries and their DuckDB oracle SQL
* ``session``    session settings and the shared checkpoint folder
"""

__version__ = "0.1.0"
