"""Retail demand recovery and forecasting on Spark DataFrames."""
