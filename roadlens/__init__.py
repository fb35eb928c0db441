"""roadlens — driving-behaviour analytics expressed as Spark DataFrame plans.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, Spark ML and Structured Streaming, so the same code runs on a
bounded table (batch) and on an unbounded source (streaming).
"""

__version__ = "0.1.0"
