"""Operators for training-data pipelines.  Nothing outside this subpackage
imports it; queries and their SQL are in ``llm.queries``."""
