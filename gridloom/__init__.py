"""Meter analytics and forecasting on Spark DataFrames."""
