"""Retail supply-chain analytics on Spark: landing, typing, marts, history, quality, serving."""
