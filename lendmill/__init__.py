"""Spark-native analytics for a digital-lending lakehouse.

Every operator is a function from DataFrames to a DataFrame built from Spark's
own expressions; nothing here plans, schedules or stores data by itself.
"""
