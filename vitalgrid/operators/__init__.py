"""DataFrame -> DataFrame operators. A site is always a column, never a loop."""
