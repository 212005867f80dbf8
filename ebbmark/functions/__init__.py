"""Column functions: batch clocks, day text and names."""
