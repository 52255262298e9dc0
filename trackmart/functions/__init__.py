"""Column-level helpers (all built-in expressions, no Python UDF)."""

from trackmart.functions.columns import *  # noqa: F401,F403
