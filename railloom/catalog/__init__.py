"""Every registered query with its check SQL, over the star-schema test tables."""

from . import fixpoints, imports, networks, projects, relational, scalars, scenarios, summaries  # noqa: F401
from .registry import CHECKS, QUERIES  # noqa: F401
