"""Whole plans: the batch pipeline and the queries over its marts."""
