"""funnelforge: product-telemetry, identity and revenue analytics on Spark.

Layers
------
* ``sources``   – bronze readers (NDJSON events, nested CRM / billing exports),
                  streaming sources and sinks, TESTDATA adapters.
* ``functions`` – Column-level helpers: JSON extraction, cross-engine
                  semantics (rounding, hour boundaries, epoch casts), the
                  compiled event contract.
* ``operators`` – DataFrame -> DataFrame transforms: staging, identity
                  resolution, marts, data-quality checks, incremental upsert.
* ``plans``     – end-to-end pipeline, golden business metrics, the query
                  catalogue used by ``__spark_entry__`` and its DuckDB oracles.
* ``streaming`` – Structured Streaming ingestion (contract routing, dedup).
"""

__version__ = "0.1.0"
