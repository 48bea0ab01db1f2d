"""Columns whose value depends on who asks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what an unprivileged reader sees in place of a name.
RESTRICTED = "*** RESTRICTED ***"
PRIVILEGED_ROLES = ("ACCOUNTADMIN", "TRANSFORMER", "LOADER")


def may_see(role: Column | str, privileged: Iterable[str] = PRIVILEGED_ROLES) -> Column:
    """Whether the role is privileged. A plain string is folded away at planning time."""
    role = F.lit(role) if isinstance(role, str) else role
    return role.isin(list(privileged))


def masked(column: str, role: Column | str, privileged: Iterable[str] = PRIVILEGED_ROLES) -> Column:
    return F.when(may_see(role, privileged), F.col(column)).otherwise(RESTRICTED).alias(column)


def nulled(column: str, role: Column | str, privileged: Iterable[str] = PRIVILEGED_ROLES) -> Column:
    """NULL for the unprivileged, so that averages over the column stay honest."""
    return F.when(may_see(role, privileged), F.col(column)).alias(column)
