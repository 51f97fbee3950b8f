"""tallybeat: media revenue analytics as plain Spark DataFrame jobs.

Layers: ``sources`` (read, write, catalog) -> ``operators`` (conform, dedupe, join,
rank, quality) -> ``plans`` (the tables of the lakehouse) and ``streaming`` (ingest).
Every operator and plan is a function from DataFrame to DataFrame; only ``sources``,
``streaming`` and ``jobs`` touch paths and table names.
"""

__version__ = "0.1.0"
