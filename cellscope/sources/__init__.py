"""Sources and sinks: measurement CSV, positional text lines, key-ordered text output, test view."""
