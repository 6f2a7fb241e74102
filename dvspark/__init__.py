"""dvspark: a Spark-native Data Vault 2.0 warehouse for quotes and FX rates.

Layers: landed files / messages -> raw (first arrival wins) -> vault
(hubs, links, satellites with MD5 keys and hash-diff change detection)
-> daily marts, plus quality gates and Structured Streaming ingestion.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark built-in expressions; only the ``publish_*`` and stream helpers run
actions.
"""

__version__ = "0.1.0"
