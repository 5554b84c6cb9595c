"""Column-level helpers (Column -> Column); all built from Spark SQL
expressions so they stay inside whole-stage code generation."""

from .scalars import *  # noqa: F401,F403
from .text import *  # noqa: F401,F403
