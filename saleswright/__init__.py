"""Prepare, check and analyse distributor sales transactions with Spark DataFrames."""
