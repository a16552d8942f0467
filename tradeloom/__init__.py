"""Procurement-marketplace analytics as lazy Spark DataFrame jobs."""
