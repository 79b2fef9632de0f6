"""Operators: lazy DataFrame in, lazy DataFrame out."""
