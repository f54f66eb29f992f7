"""Fichario: company-registry analytics as PySpark DataFrame jobs."""
