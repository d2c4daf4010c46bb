"""Ticket and issue flow analytics on Spark DataFrames."""
