"""Event-sourced order, wallet and order-book analytics on Spark DataFrames."""
