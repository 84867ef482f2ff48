"""Options of a replication and how they are resolved: request, then environment, then automatic."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import Any

from .functions.scalars import bounded_size
from .operators.segments import BATCH_BYTES, LARGEST_SEGMENT, LEAST_SEGMENT

PREFIX = "RILLSTONE_"


@dataclass(frozen=True)
class Options:
    parallel_collections: int = 0
    read_workers: int = 0
    insert_workers: int = 0
    apply_workers: int = 0
    segment_size: str = "0"
    batch_size: str = "0"
    flush_interval_ms: int = 1000
    batch_ops: int = 5000
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()

    @classmethod
    def resolve(cls, request: Mapping[str, Any] | None = None, environment: Mapping[str, str] | None = None) -> Options:
        request, environment = request or {}, os.environ if environment is None else environment
        unknown = set(request) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown options: {', '.join(sorted(unknown))}")
        found: dict[str, Any] = {}
        for f in fields(cls):
            if request.get(f.name) is not None:
                found[f.name] = request[f.name]
            elif (text := environment.get(PREFIX + f.name.upper())) is not None:
                found[f.name] = int(text) if isinstance(f.default, int) else tuple(filter(None, text.split(","))) if isinstance(f.default, tuple) else text
        out = cls(**found)
        bounded_size(out.segment_size, LEAST_SEGMENT, LARGEST_SEGMENT)
        bounded_size(out.batch_size, 16_000_000, BATCH_BYTES)
        for name in ("parallel_collections", "read_workers", "insert_workers", "apply_workers"):
            if getattr(out, name) < 0:
                raise ValueError(f"{name} is negative")
        return out

    def automatic(self, cpus: int) -> dict[str, int]:
        """Numbers of workers, with what is left open chosen by the number of processors."""
        chosen = {"parallel_collections": 2, "read_workers": max(cpus // 4, 1), "insert_workers": 2 * cpus, "apply_workers": cpus}
        return {k: getattr(self, k) or v for k, v in chosen.items()}
