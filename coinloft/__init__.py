"""Retail-banking lakehouse on Spark: bronze, silver and gold tables, data
quality, reports, maintenance, streaming refresh and model features."""
