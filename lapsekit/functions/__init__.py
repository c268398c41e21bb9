"""Column expressions; everything here returns a ``Column`` and runs no job."""
