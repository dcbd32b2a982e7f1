"""Cleaning, normalising, checking and publishing lending-library data on Spark."""
