"""Scalar functions: column expressions where they can be, vectorised numpy where they must."""
