"""Contract-driven table ingestion on Spark: extract, land, align, cast, quarantine, audit."""

from quayside.plans.ingest import IngestParams, LandedLines, RunResult, run
from quayside.sources.contract import Contract, Field, parse_contract, read_contract
from quayside.sources.paged import PagedService, PageRequest

__all__ = [
    "Contract",
    "Field",
    "IngestParams",
    "LandedLines",
    "PageRequest",
    "PagedService",
    "RunResult",
    "parse_contract",
    "read_contract",
    "run",
]
