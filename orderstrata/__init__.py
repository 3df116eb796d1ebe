"""Layered sales analytics on Spark DataFrames: raw text, store and publish tables, reports."""
