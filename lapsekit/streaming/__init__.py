"""The row-local part of the library on unbounded input."""
