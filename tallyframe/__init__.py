"""Analytics jobs on ratings, text reviews, sales and camera frames, as lazy Spark DataFrames."""
