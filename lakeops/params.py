"""Text parameters of the city reports."""

from __future__ import annotations

import re
from dataclasses import dataclass

# fixed values: cities whose tables do not carry their name
CITY_PREFIX = {"stockholm": "stock"}


def city_prefix(city: str) -> str:
    """Table prefix of a city: its name in lower case, unless its tables have a shorter one."""
    name = city.strip().lower()
    if not re.fullmatch(r"\w+", name):
        raise ValueError(f"{city!r} is no table prefix")
    return CITY_PREFIX.get(name, name)


@dataclass(frozen=True)
class Params:
    """Where the city tables lie, and which cities to report on (comma-separated text)."""

    catalog: str | None = None
    schema: str = "gold"
    cities_csv: str = "Stock,Berlin"

    @property
    def cities(self) -> list[str]:
        return [name for name in map(str.strip, self.cities_csv.split(",")) if name]

    def table(self, name: str) -> str:
        parts = [self.catalog, self.schema, name]
        return ".".join(part for part in parts if part)

    def city_table(self, city: str, suffix: str) -> str:
        return self.table(f"{city_prefix(city)}_{suffix}")
