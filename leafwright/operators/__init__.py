"""Operators of the document model: DataFrame in, DataFrame out."""
