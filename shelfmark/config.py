"""Job parameters: command line first, then environment, then default."""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class JobConfig:
    # Names and defaults of the settings. `paginas`: None means every page of the log.
    paginas: int | None = None
    per_page: int = 50
    pausa_base: float = 1.0
    umbral_remaining: int = 10
    min_desc_len: int = 50
    k: int = 5
    bronze_dir: str = "bronze"
    silver_dir: str = "silver"
    gold_dir: str = "gold"
    reports_dir: str = "reports"
    source: str = "catalog_api"
    table_buckets: int = 64
    index_cells: int = 64
    index_probes: int = 32
    index_tables: int = 16
    index_bits: int = 4
    scratch_dir: str | None = None

    def __post_init__(self):
        if self.k < 1:
            raise ValueError(f"k must be at least 1, got {self.k}")

    @property
    def table_dir(self) -> str:
        return f"{self.silver_dir}/entries"

    @property
    def quarantine_dir(self) -> str:
        return f"{self.silver_dir}/quarantine"

    @property
    def ledger_dir(self) -> str:
        return f"{self.bronze_dir}/failed_pages"

    @property
    def landing_dir(self) -> str:
        return f"{self.bronze_dir}/landing"

    @property
    def vectors_dir(self) -> str:
        return f"{self.gold_dir}/vectors"


# Environment names, where they differ from the upper-cased field name.
_ENV_NAMES = {"k": "SEARCH_K"}


def from_args(argv: list[str] | None = None) -> JobConfig:
    parser = argparse.ArgumentParser(description="Catalogue quality and semantic search on Spark")
    for field in fields(JobConfig):
        cast = int if field.name == "paginas" else type(field.default) if field.default is not None else str
        from_env = os.environ.get(_ENV_NAMES.get(field.name, field.name.upper()))
        default = field.default if from_env is None else cast(from_env)
        parser.add_argument(f"--{field.name.replace('_', '-')}", type=cast, default=default)
    known, _ = parser.parse_known_args(argv)
    return JobConfig(**vars(known))
