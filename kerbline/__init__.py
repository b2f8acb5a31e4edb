"""Incident analytics as Spark DataFrame operators.

``functions`` holds column expressions, ``operators`` DataFrame to DataFrame
steps, ``sources`` readers and writers, ``plans`` the end-to-end jobs.
"""
