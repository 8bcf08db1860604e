"""tillguard — card-terminal fraud analytics as Spark DataFrame jobs.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Catalyst expressions, windows, joins and aggregates.  Python (pandas/numpy
inside Spark tasks) is used only where Spark has no built-in: the isolation
forest and the keyed streaming state.
"""

__version__ = "0.1.0"
