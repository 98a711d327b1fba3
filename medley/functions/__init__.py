"""Column expressions: Column in, Column out, all evaluated by Spark itself."""
