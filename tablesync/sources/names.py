"""Object names: one to three parts, completed from defaults, always quoted in generated SQL."""

from __future__ import annotations

from dataclasses import dataclass

from tablesync.errors import SyncError


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class EntityName:
    catalog: str
    schema: str
    table: str

    @property
    def quoted(self) -> str:
        return ".".join(quote(part) for part in (self.catalog, self.schema, self.table))

    def __str__(self) -> str:
        return f"{self.catalog}.{self.schema}.{self.table}"


def resolve_entity(text: str, catalog: str | None = None, schema: str | None = None) -> EntityName:
    """``table``, ``schema.table`` or ``catalog.schema.table``; missing parts come from the defaults."""
    if "`" in text:
        raise SyncError(f"'{text}': backticks are not accepted; write the plain object name")
    parts = text.split(".")
    if len(parts) > 3 or not all(parts):
        raise SyncError(f"'{text}' is not a name of one to three parts")
    padded = [None] * (3 - len(parts)) + parts
    found = (padded[0] or catalog, padded[1] or schema, padded[2])
    missing = [label for label, part in zip(("catalog", "schema"), found) if not part]
    if missing:
        raise SyncError(f"'{text}' cannot be resolved: no default {' and no default '.join(missing)}")
    return EntityName(*found)
