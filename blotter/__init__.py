"""blotter: incident analytics on Spark.

Ingest raw incident files (batch or incremental stream), gate rows on named
quality rules, enrich them, build a star schema (eight dimensions and a fact
with deterministic surrogate keys), profile the raw data and answer the
dashboard questions, all as DataFrame -> DataFrame operators.
"""

__version__ = "0.1.0"
