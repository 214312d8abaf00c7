"""Reading raw weekly files and prepared tables, and writing the results."""
