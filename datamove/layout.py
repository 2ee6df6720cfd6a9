"""Where each layer keeps its files and what its tables are called."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Place:
    """A table: its files, its database, and its name inside the database."""

    path: str
    database: str
    name: str
    view: str

    @property
    def table(self) -> str:
        return f"{self.database}.{self.view}"


@dataclass(frozen=True)
class Layout:
    """Naming rules for the layers, with storage root and environment as parameters.

    ``path`` and ``name`` are stems; published copies carry an ``_a`` or ``_b`` suffix
    and ``view`` is the stable name readers use.
    """

    root: str = "s3://"
    env: str = "dev"

    def raw(self, group: str, schema: str, obj: str) -> Place:
        name = f"{schema}__{obj}"
        return Place(self._bucket(group, "raw", schema, obj), f"{group}_raw_{self.env}", name, name)

    def landing(self, group: str, schema: str) -> str:
        return self._bucket(group, "landing", schema)

    def processed(self, group: str, schema: str) -> str:
        return self._bucket(group, "processed", schema)

    def conformance(self, group: str, obj: str) -> Place:
        return Place(
            self._bucket(group, "conformance", obj), f"{group}_conformance_{self.env}", obj, f"{obj}_tv"
        )

    def published(self, group: str, obj: str) -> Place:
        return Place(self._bucket(group, "published", obj), group, obj, f"{obj}_tv")

    def _bucket(self, group: str, layer: str, *parts: str) -> str:
        return "/".join([f"{self.root}{group}-{layer}-{self.env}", *parts])


def backup_path(path: str, moment: dt.datetime) -> str:
    """Sibling of ``path`` for the state it had at ``moment``."""
    parent, _, leaf = path.rstrip("/").rpartition("/")
    return f"{parent}/backup/{moment:%Y%m%d_%H%M%S}/{leaf}"
