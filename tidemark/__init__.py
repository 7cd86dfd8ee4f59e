"""tidemark: inbound purchase-order milestones on Spark.

Config-driven ingest of source extracts into bronze tables, per-key facts of
purchase orders and shipments, and a single-pass milestone computation
published as a silver table.  See README.md.
"""
__version__ = "0.1.0"
