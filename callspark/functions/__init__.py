"""Column functions: expressions that stay inside one row and never shuffle."""
