"""Resumable record annotation and taxonomy reporting on Spark DataFrames."""

__version__ = "0.1.0"
