"""Shopping-behaviour and advertising analytics as Spark DataFrame jobs."""
