"""Reading and writing of tables."""
