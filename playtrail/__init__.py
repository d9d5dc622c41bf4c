"""User-activity and churn analytics on Spark DataFrames.

Every operator is a function of DataFrames. Session, paths and sinks belong to
the caller.
"""
