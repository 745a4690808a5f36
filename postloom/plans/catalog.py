"""All queries outside the subpackage for training text."""

from __future__ import annotations

from postloom.plans import problems, reference

QUERIES = reference.QUERIES | problems.QUERIES
SQL = reference.SQL | problems.SQL
