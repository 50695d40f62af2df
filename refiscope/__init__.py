"""Loan refinancing-risk analytics expressed as Spark DataFrame jobs."""
