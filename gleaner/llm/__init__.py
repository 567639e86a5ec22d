"""Operators of a training-data pipeline, each by one named method, with their queries."""
