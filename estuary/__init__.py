"""estuary – Spark-native analytics for spatio-temporal series, conversation
logs, conversation/embedding tables and serving records.

Operators are functions DataFrame(s) → DataFrame (``estuary.operators``),
streaming variants live in ``estuary.streaming``, scans/sinks in
``estuary.sources`` and plan helpers (ordinals, halo windows, blocked scans)
in ``estuary.plans``. ``estuary.catalog`` registers one query per operator.
"""

__version__ = "0.1.0"
