"""Column expressions: each takes Columns and returns a Column, so batch and streaming
frames accept them alike."""
