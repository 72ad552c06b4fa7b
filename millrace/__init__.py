"""Incremental table loading on Spark: backfill and change log in, current tables out."""
