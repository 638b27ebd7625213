"""Batch operators: pure DataFrame -> DataFrame functions and fitted models."""
