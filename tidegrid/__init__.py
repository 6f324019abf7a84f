"""Model-ready ocean grids as Spark DataFrame operators."""
