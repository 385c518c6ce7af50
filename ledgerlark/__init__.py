"""Provider-risk analytics over insurance claims, written as PySpark DataFrame jobs."""

__version__ = "0.1.0"
