"""pricelens: price-observation analytics as lazy Spark DataFrame functions.

Every operator takes a DataFrame (plus column names as keyword arguments)
and returns a DataFrame.  Nothing is collected inside an operator; the
only actions live in ``plans.pipeline`` (writes) and in the caller.
"""

__version__ = "0.1.0"
