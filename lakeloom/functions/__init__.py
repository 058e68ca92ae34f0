"""Column functions: cleaning, typing, keys and business attributes."""
