"""Where data comes from and goes to: landing files, bronze days, published tables, JDBC."""
