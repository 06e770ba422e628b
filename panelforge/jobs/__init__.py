"""Source pipelines (D1-D14): each is a composition of the library's
operators with the source's column names and rules. Inputs are landed files
(or DataFrames); outputs are DataFrames, written as Parquet by ``etl``."""
