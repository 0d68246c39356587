"""Spark jobs that turn crawled marketplace pages into one clean product table."""
