"""Batch jobs put together from the operators."""
