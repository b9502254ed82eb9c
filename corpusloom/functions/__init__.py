"""Column functions: text, markup, replies, vectors, and SQL function registry."""
