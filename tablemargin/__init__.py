"""tablemargin: restaurant-finance analytics as plain Spark DataFrame operators.

Operators take DataFrames (or Columns) and return DataFrames (or Columns).  They are lazy, except
those that change tables and those with a `staged` argument, which write an intermediate result
that is read several times to the shared scratch folder.
"""
