"""Which tables feed which operators: views over the test tables, queries, layers."""
