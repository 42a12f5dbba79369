"""Learn ratings from review text with Spark: clean, tokenise, stem, weigh, train, tune, report."""

__version__ = "0.1.0"
