"""Screening, monitoring and alert-summary jobs as PySpark DataFrame functions."""
