"""Column-name cleaning, used both on tables and on configured names."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable


def clean_name(name: str) -> str:
    """Trim, join words by ``_``, drop punctuation, lower-case; letters of any script stay."""
    words = re.sub(r"\s+", " ", name.strip())
    return re.sub(r"[^\w\s]", "", words).replace(" ", "_").lower()


def clean_list(names: Iterable[str] | None) -> list[str]:
    return [clean_name(n) for n in names or []]


def clashes(names: Iterable[str]) -> list[str]:
    """Names that occur twice; Spark compares them without case."""
    seen = Counter(n.lower() for n in names)
    return sorted(n for n, k in seen.items() if k > 1)
