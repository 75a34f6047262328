"""Service-request ELT and reporting on Spark DataFrames."""

__version__ = "0.1.0"
