"""Reading and writing the landed, refined and vector tables."""
