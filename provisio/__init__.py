"""provisio — credit-risk data operators on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` or ``Column -> Column``
function built from Spark SQL expressions, so Catalyst can prune, push down
and code-generate it, and the same code serves batch and (where it makes
sense) Structured Streaming.
"""

__version__ = "0.1.0"
