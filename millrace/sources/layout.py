"""Where tables live: ``base/layer/table`` plus landing, QA and report folders."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

LAYERS = ("bronze", "silver", "gold")
STAMP = "%Y%m%d_%H%M%S"


def run_stamp(at: datetime) -> str:
    """``20240131_235959``, the suffix of folders that must be unique per run."""
    return at.strftime(STAMP)


@dataclass(frozen=True)
class Layout:
    base: str

    def table(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
        return f"{self.base}/{layer}/{name}"

    def year(self, layer: str, name: str, year: int) -> str:
        return f"{self.table(layer, name)}/{year:04d}"

    def landing(self, name: str) -> str:
        return f"{self.base}/landing/{name}"

    def landed(self, name: str) -> str:
        """Bronze rows written by the streaming ingest, one folder per batch of the stream."""
        return f"{self.table('bronze', name)}/landed"

    def ranged(self, name: str) -> str:
        """Bronze rows written by the date-range ingest."""
        return f"{self.table('bronze', name)}/ranged"

    def repaired(self, name: str) -> str:
        """Bronze rows added by the repair of incomplete days, one folder per run."""
        return f"{self.table('bronze', name)}/repaired"

    def attempt(self, name: str, at: datetime) -> str:
        """Folder a refetch of ``name`` is delivered to."""
        return f"{self.base}/qa/{name}/attempt{run_stamp(at)}"

    def qa(self, name: str, log: str) -> str:
        return f"{self.base}/qa/{name}/{log}"

    def qa_log(self, name: str, at: datetime) -> str:
        return f"{self.qa(name, 'logs')}/{run_stamp(at)}"

    def state(self, name: str) -> str:
        """Log of what finished runs have loaded and checked, one row per run."""
        return f"{self.base}/_state/{name}"

    def changes(self, name: str) -> str:
        """Change log of a bronze table, one folder per feed and part."""
        return f"{self.base}/_changes/{name}"

    def taken(self, name: str, consumer: str) -> str:
        """Parts of the change log a consumer has taken in."""
        return f"{self.base}/_state/{name}_taken_by_{consumer}"

    def step(self, at: datetime, step: str) -> str:
        """Marker of a finished step of a run."""
        return f"{self.base}/_state/steps/{run_stamp(at)}/{step}"

    def entries(self, slot: int) -> str:
        """Last gold entry of every customer and product; two slots, written in turn."""
        return f"{self.base}/_state/last_entries/slot{slot}"

    def report(self, name: str) -> str:
        return f"{self.base}/sales_report/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/_checkpoints/{name}"
