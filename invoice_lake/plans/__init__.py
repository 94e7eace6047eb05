"""Whole jobs and reports put together from sources and operators."""
