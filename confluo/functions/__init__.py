"""Scalar functions as Column expressions; Arrow functions only where no expression exists."""
