"""Column functions: time features and scalar helpers (log1p, text formats, colour bands, guards)."""
