"""DataFrame-to-DataFrame operators; narrow unless their docstring names a shuffle."""
