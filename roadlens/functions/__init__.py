"""Column-expression builders (all JVM-side built-ins; no Python UDFs)."""

from .expressions import *  # noqa: F401,F403
