"""Tidemark: order analysis, catalogue cleaning, star schemas and layered event tables as Spark DataFrame operators."""
