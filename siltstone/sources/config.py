"""Configuration, its digest, and checks of paths, all before anything is written."""

from __future__ import annotations

import json
import os
import re
from dataclasses import asdict, dataclass, field

from siltstone.contracts import digest


@dataclass(frozen=True)
class Limits:
    batch_rows: int = 4096
    batch_bytes: int = 8 << 20
    field_bytes: int = 1 << 20
    record_bytes: int = 4 << 20
    expansion_ratio: int = 1000
    decompressed_bytes: int = 1 << 42


@dataclass(frozen=True)
class Config:
    raw_roots: tuple[str, ...]
    intermediate_root: str
    quarantine_root: str
    release_root: str
    provider: str
    builder_version: str = "siltstone-1"
    compression: str = "zstd"
    shard_bytes: int = 512 << 20
    limits: Limits = field(default_factory=Limits)
    views: tuple[str, ...] = ("replay_events", "games", "decision_imitation")
    #: Kept for the audit only, so not part of the digest.
    started_at: str | None = None


class PathError(ValueError):
    """A path lies where it must not."""


def load_config(path: str) -> Config:
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    found["raw_roots"] = tuple(found["raw_roots"])
    found["limits"] = Limits(**found.get("limits", {}))
    if "views" in found:
        found["views"] = tuple(found["views"])
    config = Config(**found)
    check_roots(config)
    return config


def config_digest(config: Config) -> str:
    """Of what shapes results: neither times nor where things lie."""
    kept = asdict(config)
    for name in ("started_at", "raw_roots", "intermediate_root", "quarantine_root", "release_root"):
        del kept[name]
    return digest(kept)


def inside(path: str, root: str) -> bool:
    path, root = os.path.realpath(path), os.path.realpath(root)
    return os.path.commonpath([path, root]) == root


def check_roots(config: Config) -> None:
    """Reject output roots that lie in, around or at a raw root, links resolved."""
    for raw in config.raw_roots:
        for out in (config.intermediate_root, config.quarantine_root, config.release_root):
            if inside(out, raw) or inside(raw, out):
                raise PathError(f"output root {out} and raw root {raw} overlap")
    if inside(config.quarantine_root, config.release_root) or inside(config.release_root, config.quarantine_root):
        raise PathError("the quarantine must lie outside the release")


def resolve_under(root: str, relative: str) -> str:
    """``relative`` below ``root``; traversal and links that lead out are rejected."""
    found = os.path.realpath(os.path.join(root, relative))
    if os.path.isabs(relative) or not inside(found, root):
        raise PathError(f"{relative} leads out of its root")
    return found


def safe_name(identifier: str) -> str:
    """The identifier, if it can be part of a file name."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", identifier or ""):
        raise PathError(f"{identifier!r} is no safe name")
    return identifier
