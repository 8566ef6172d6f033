"""Spark-first analytics engine for versioned registers of structured documents."""
