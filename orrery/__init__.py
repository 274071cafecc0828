"""Versioned vector-index engine expressed in PySpark DataFrames."""
