"""The row-wise operators on a stream."""
