"""casebook: Spark-native retail, delivery and subscription analytics.

Reusable DataFrame operators (``casebook.operators``), column functions
(``casebook.functions``), typed sources and sinks (``casebook.sources``) and a
catalogue of named business jobs composed from them (``casebook.plans``).
"""

__version__ = "0.1.0"
