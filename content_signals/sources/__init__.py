"""Readers: files and landed JSON to DataFrames."""
