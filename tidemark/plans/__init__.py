"""Specifications turned into DataFrames: metric runs, quality runs and transform steps."""
