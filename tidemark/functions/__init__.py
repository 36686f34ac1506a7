"""Column expressions: normalised values, JSON payloads, record keys, cursors, defaults."""
