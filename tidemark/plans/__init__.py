"""Silver and gold tables and the business rules, as lazy DataFrames."""
