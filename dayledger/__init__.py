"""dayledger — a Spark-native engine for event, measurement and panel analytics.

Layers (each one a plain Python module of DataFrame -> DataFrame functions):

* ``functions``  scalar Column helpers (local dates, whole months, keys, JSON)
* ``sources``    reads: driver tables, landing reads, seeds, calendars
* ``operators``  generic operators: sinks / table maintenance, staging
                 operators, set operations, data-quality checks, privacy jobs
* ``plans``      the modelled warehouse bound to the driver's tables:
                 facts, dimensions, wearable-style day aggregates, the dense
                 user x day panel, metrics and reconciliation checks
* ``streaming``  Structured Streaming forms of the late-data operators
"""

__version__ = "0.1.0"
