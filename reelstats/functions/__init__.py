"""Column expressions shared by the operators (all built-in, JVM side)."""

from reelstats.functions.scalars import *  # noqa: F401,F403
