"""Reading and writing: lake folders and relational tables."""
