"""Composite table builders made of the operators."""
