"""Transit feed quality and delay analytics on PySpark DataFrames."""
