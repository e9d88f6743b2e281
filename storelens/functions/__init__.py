"""Column helpers and the scale-safe building blocks the operators share."""
