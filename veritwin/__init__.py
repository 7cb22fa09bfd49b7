"""veritwin: compare two snapshots of structured metadata at fleet scale, on Spark."""

__version__ = "0.1.0"
