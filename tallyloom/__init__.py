"""Label-quality and classification jobs for transaction-like tables on Spark DataFrames."""
