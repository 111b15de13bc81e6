"""Reading and writing files, catalog tables and databases."""
