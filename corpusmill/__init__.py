"""corpusmill: web-crawl corpora on Spark, as composable DataFrame -> DataFrame functions."""

__version__ = "0.1.0"
