"""Operators: DataFrame -> DataFrame transforms of the order model."""
