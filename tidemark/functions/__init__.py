"""Column -> Column helpers; every one is a built-in Spark expression."""
