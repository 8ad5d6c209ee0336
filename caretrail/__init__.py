"""Longitudinal health-record analytics as Spark DataFrame jobs."""
