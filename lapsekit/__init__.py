"""Churn analytics as lazy Spark plans.

Sub-packages: ``sources`` (reading and writing tables), ``functions`` (column
expressions), ``operators`` (DataFrame to DataFrame steps), ``plans`` (step
lists, multi-table runs, plan sizing) and ``streaming`` (row-local steps and
scoring on unbounded input).
"""
