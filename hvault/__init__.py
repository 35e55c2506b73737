"""Historised warehouse (Data Vault) operators on Spark DataFrames."""
