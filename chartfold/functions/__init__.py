"""Column functions: Column in, Column out, all of them native expressions."""
