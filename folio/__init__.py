"""Document queries on Spark: a typed query model compiled to DataFrame and Column expressions."""
