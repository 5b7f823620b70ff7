"""Choices about physical strategy, and the composed jobs."""
