"""Reelhouse: media-catalogue analytics as lazy PySpark DataFrame operators.

Operators take DataFrames and return DataFrames; they run no action, never
create or stop a session, and never read the clock. Actions happen only in the
sinks and in the table-building plans that call them.
"""
