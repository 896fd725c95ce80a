"""Delivery analytics on Spark: chunk files -> core tables -> daily marts."""
