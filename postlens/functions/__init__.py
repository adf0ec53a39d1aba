"""Column expressions (JVM-side, codegen'd): text cleaning, statistics,
token extraction, deterministic hashing, activations."""

from postlens.functions.text import *  # noqa: F401,F403
from postlens.functions.hashing import *  # noqa: F401,F403
