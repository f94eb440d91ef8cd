"""The row-wise operators on an unbounded input."""
