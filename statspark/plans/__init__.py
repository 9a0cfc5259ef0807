"""Jobs that compose the operators."""
