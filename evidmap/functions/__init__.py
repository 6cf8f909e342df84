"""Column functions: everything here takes and returns ``Column`` objects."""
