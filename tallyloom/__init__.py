"""Keyword ranking, question-and-answer clustering and time-use averages on Spark DataFrames."""
