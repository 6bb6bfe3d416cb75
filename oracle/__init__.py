"""The expected results, as plain SQL over the test tables."""
