"""Column functions. Everything here builds expressions; nothing runs Python per row."""
