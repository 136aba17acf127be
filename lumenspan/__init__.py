"""Spectral imagery analytics on Spark DataFrames."""
