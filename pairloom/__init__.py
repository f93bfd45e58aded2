"""Analytics for corpora of paired text (a request and the code that answers it) on Spark."""
