"""Retail demand features, forecasts and monitoring as Spark DataFrame jobs."""
