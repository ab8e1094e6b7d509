"""Crawl and link-graph analytics as Spark DataFrame operators."""
