"""Operators put together: training, prediction, back-test."""
