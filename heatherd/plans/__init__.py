"""Pipelines made of several operators: work plans, resumable runs, sampled validation."""
