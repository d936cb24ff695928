"""Marketing data vault on Spark: DataFrame operators from raw extracts to lead marts."""
