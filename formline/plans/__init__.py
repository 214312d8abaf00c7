"""Whole pipelines: the prepare stage and the registered queries with their SQL twins."""
