"""Named queries over the shared tables, and the same in SQL."""
