"""eventide: event-stream analytics on PySpark.

sources     inline rows, driver tables, CSV / JSON sources, sinks
functions   scalar column functions (text, time, predicates, report lines)
operators   windows, sessions, keyed scans, rolling values, threshold batches,
            periods, joins, validation, weighted assignment
streaming   stream I/O with checkpoints, state processors, streaming jobs
plans       the reference jobs (``jobs``) and the registered queries (``catalog``)
"""
