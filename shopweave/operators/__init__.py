"""Cleaning, upserts and metrics, as functions from DataFrames to a DataFrame."""
