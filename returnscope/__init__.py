"""Release-impact analytics on Spark: staging, star schema, marts and analyses
of a product release, as DataFrame operators."""

__version__ = "0.1.0"
