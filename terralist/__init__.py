"""Listing analytics on Spark: plain DataFrame and Column functions."""
