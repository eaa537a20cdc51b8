"""All registered queries."""

from __future__ import annotations

import checks.silver  # noqa: F401, I001 - importing registers the queries
import checks.models  # noqa: F401
import checks.columns  # noqa: F401
import checks.groups  # noqa: F401
import checks.reports  # noqa: F401
import checks.live  # noqa: F401
import checks.stored  # noqa: F401
from checks.registry import ENTRIES


def names() -> list[str]:
    return list(ENTRIES)
