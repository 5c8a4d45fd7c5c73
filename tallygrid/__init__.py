"""tallygrid: spatial event statistics and public-count pipelines on PySpark."""

__version__ = "0.1.0"
