"""Payments-ledger analytics on Spark: ingest, clean, score, summarise, publish, report."""
