"""Retail price intelligence jobs on Apache Spark."""
