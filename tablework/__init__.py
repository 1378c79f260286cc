"""Batch data jobs on tables and text, written as Spark DataFrame plans."""
