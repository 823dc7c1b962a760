"""Column functions: text, URL, hashing, HTML and time."""
