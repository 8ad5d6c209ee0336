"""Registered queries, by section of the operator inventory."""

from caretrail.checks import care, flatten, forms, incremental, indicators, programs, relational, reports, scalar, timeline  # noqa: F401
from caretrail.checks.registry import CHECKS  # noqa: F401
