"""All registered queries."""

from __future__ import annotations

import checks.fused  # noqa: F401
import checks.live  # noqa: F401
import checks.marts  # noqa: F401
import checks.quality  # noqa: F401
import checks.scalars  # noqa: F401
import checks.tables  # noqa: F401
from checks.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
