"""Stream entry points of the row-wise operators."""
