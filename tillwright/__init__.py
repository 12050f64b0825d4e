"""Retail and experiment analytics as Spark DataFrame jobs.

Every public function takes and returns DataFrames and runs no action, save
for the sinks, the stream and ``session.durable``.
"""
