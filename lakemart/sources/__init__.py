"""Reading and writing: the only modules that touch storage."""
