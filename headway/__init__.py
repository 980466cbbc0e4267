"""headway: public-transport schedule and road-traffic analytics on Spark DataFrames."""
