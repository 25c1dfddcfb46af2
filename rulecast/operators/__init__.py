"""Relational operators the plans are built from: DataFrame in, DataFrame out."""
