"""Settings of the jobs. Addresses and secrets come from arguments or the
environment, never from literals in the code."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Granularity:
    """One roll-up width with the retention and dashboard range that go with it."""

    name: str
    width: str
    keep: str
    dashboard_range: str


# --- fixed values --------------------------------------------------------------
ONE_MINUTE = Granularity("1min", "1 minute", keep="7 days", dashboard_range="1 hour")
QUARTER_HOUR = Granularity("15min", "15 minutes", keep="1 year", dashboard_range="6 hours")
GRANULARITIES = (ONE_MINUTE, QUARTER_HOUR)
BUSINESS_ZONE = "Europe/Berlin"
LATENESS = "2 minutes"
GOLD_TRIGGER = "1 minute"
DEFAULT_HOUSE = "2113"


@dataclass(frozen=True)
class Pipeline:
    """Where the layers live and how the streams run.

    ``names`` places single layers (``silver``, ``gold_1min``, ``serving_15min``...)
    elsewhere than below ``root``, such as on a table that is already there.

    ``state_partitions`` is frozen into a Gold checkpoint by its first batch, so
    choose it for the data to come: a later change is ignored by that query.
    ``write_width`` tasks write a micro-batch, and ``write_salt`` of them share an
    hour: the hash of (date, hour) alone would leave a batch, which touches one or
    two hours, to one or two tasks. Without ``write_width`` a batch is written by as
    many tasks as the session shuffles to, which a backfill of many hours needs.

    ``rows_per_file`` is what a Gold file of a live query should hold: where batches have been measured, ``write_width`` and
    ``write_salt`` follow from them at the next start, up to ``most_writers``.

    ``backlog_hours`` folders of Silver are one step of a backlog, and bound its state.
    """

    root: str
    zone: str = BUSINESS_ZONE
    lateness: str = LATENESS
    ingest_trigger: str | None = None
    gold_trigger: str | None = GOLD_TRIGGER
    available_now: bool = False
    state_partitions: int | None = None
    write_width: int | None = 4
    write_salt: int = 4
    max_files_per_trigger: int | None = None
    backlog_hours: int = 6
    rows_per_file: int = 1_000_000
    most_writers: int = 64
    rocksdb_state: bool = True
    decimals: int | None = None
    names: Mapping[str, str] = field(default_factory=dict)

    @property
    def silver(self) -> str:
        return self.names.get("silver", f"{self.root}/silver/readings")

    def gold(self, grain: Granularity) -> str:
        return self.names.get(f"gold_{grain.name}", f"{self.root}/gold/readings_{grain.name}")

    def serving(self, grain: Granularity) -> str:
        return self.names.get(f"serving_{grain.name}", f"{self.root}/serving/readings_{grain.name}")

    @property
    def houses(self) -> str:
        return self.names.get("houses", f"{self.root}/houses")

    @property
    def metrics(self) -> str:
        return self.names.get("metrics", f"{self.root}/metrics")

    def checkpoint(self, query: str) -> str:
        """One folder per query: offsets, state and commits are never shared."""
        return f"{self.root}/_checkpoints/{query}"

    def trigger(self, interval: str | None) -> dict:
        """Keyword arguments of ``DataStreamWriter.trigger``; empty means as soon as possible."""
        if self.available_now:
            return {"availableNow": True}
        return {"processingTime": interval} if interval else {}

    def backfill(self) -> Pipeline:
        """The same pipeline, run once over everything that has arrived."""
        return replace(self, available_now=True, write_width=None)

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Pipeline:
        if not env.get("GRIDPULSE_ROOT"):
            raise ValueError("GRIDPULSE_ROOT must name the folder or bucket that holds the layers")
        given: dict = {"root": env["GRIDPULSE_ROOT"].rstrip("/")}
        for key in ("zone", "lateness", "ingest_trigger", "gold_trigger"):
            if f"GRIDPULSE_{key.upper()}" in env:
                given[key] = env[f"GRIDPULSE_{key.upper()}"]
        for key in ("state_partitions", "write_width", "write_salt", "max_files_per_trigger", "backlog_hours", "rows_per_file", "decimals"):
            if f"GRIDPULSE_{key.upper()}" in env:
                given[key] = int(env[f"GRIDPULSE_{key.upper()}"])
        layers = ["silver"] + [f"{layer}_{g.name}" for layer in ("gold", "serving") for g in GRANULARITIES]
        paths = {layer: env.get(f"GRIDPULSE_{layer.upper()}_PATH") for layer in layers}
        return cls(**given, names={layer: path for layer, path in paths.items() if path})
