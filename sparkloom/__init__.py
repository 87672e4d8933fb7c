"""Program-screen analytics on Spark DataFrames."""
