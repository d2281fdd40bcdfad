"""lodestrand: source-code intelligence on Spark DataFrames."""
