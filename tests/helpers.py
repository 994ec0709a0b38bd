"""What several test modules share, in a module of its own name: every folder has a ``conftest``."""

from __future__ import annotations

from millrace.contract import EVENTS

SF = "/root/testdata/sf0.001"


def event_line(**fields: object) -> str:
    """A contract line, blank but for the given fields."""
    return "\t".join(str(fields.get(name, "")) for name in EVENTS.names)
