"""tallyloom: catalogue reconciliation and content-quality operators as Spark DataFrames."""
