"""Spark jobs for tables of labelled, semi-structured HTML documents."""
