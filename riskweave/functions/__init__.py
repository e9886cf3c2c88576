"""Column expressions: cleaning, dates, bin search, score scaling."""
