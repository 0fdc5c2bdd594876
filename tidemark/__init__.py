"""Spark operators for daily market data: price bars, job postings, property listings."""
