"""Reading, binding, keeping and writing tables."""
