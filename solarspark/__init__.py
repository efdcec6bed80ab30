"""Photovoltaic performance analytics as Spark DataFrame operators and batch jobs."""
