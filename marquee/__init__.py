"""marquee: consolidate event listings from many sources with Spark DataFrames."""
