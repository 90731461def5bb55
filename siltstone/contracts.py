"""Contracts: versioned declarations that operators take as evidence.

Nothing about a source is built in.  An interpretation contract says which raw
column feeds which field, by what type and with what origin; a split or identity
contract fixes an algorithm's inputs.  A contract's digest changes with any part
of it, and is what later identities are made of.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field

# Closed domains of status fields, from the most complete level down.
SOURCE_KINDS = ("replay", "game", "draft", "unknown")
RECONSTRUCTION_LEVELS = ("source_direct", "deterministically_derived", "partial_reconstruction", "unavailable")
COMPLETENESS = ("complete_for_declared_view", "partial", "unknown")
LEGAL_ACTIONS = ("unknown", "source_provided_complete", "engine_reconstructed_complete", "partial")
OBSERVED_ACTION = ("observed", "reconstructed", "missing", "ambiguous")
ORIGINS = ("source_direct", "normalized_source", "deterministically_derived", "reconstructed", "engine_augmented", "unknown")
LICENSE_STATUSES = ("verified", "pending", "restricted", "unknown")
DISPOSITIONS = ("command_failure", "fatal_source", "unsupported", "rejected", "quarantined", "warning", "release_blocking")
FORBIDDEN_NAMES = ("best_action", "optimal_action", "target_status")
GROUPS = ("source", "normalized", "reconstructed", "quality")


def canonical_json(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def digest(value) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


class Contract:
    def digest(self) -> str:
        return digest({"kind": type(self).__name__, **asdict(self)})


@dataclass(frozen=True)
class FieldRule:
    """One output field: its raw column, type, group and origin.

    ``kind`` is string, integer, boolean, decimal or timestamp; ``safe`` says
    that an actor knows the value before deciding.
    """

    name: str
    raw: str
    kind: str = "string"
    group: str = "normalized"
    origin: str = "source_direct"
    required: bool = False
    scale: int = 0
    safe: bool = False

    def __post_init__(self):
        if self.group not in GROUPS or self.origin not in ORIGINS:
            raise ValueError(f"{self.name}: unknown group or origin")
        if self.name in FORBIDDEN_NAMES:
            raise ValueError(f"{self.name}: the name claims more than was observed")


@dataclass(frozen=True)
class InterpretationContract(Contract):
    """Meaning of one physical schema; may be corrected without the schema changing."""

    contract_id: str
    version: int
    raw_fingerprint: str
    header: tuple[str, ...]
    fields: tuple[FieldRule, ...]
    additive_allowed: bool = False

    def ignored(self) -> list[str]:
        return [c for c in self.header if c not in {f.raw for f in self.fields}]


@dataclass(frozen=True)
class IdContract(Contract):
    """Identity: a namespace and version, and the columns whose canonical form is hashed."""

    namespace: str
    version: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class IdentityContract(Contract):
    """By what a game or an event is known.

    ``native`` is the source's own identifier.  It identifies across archives only in the
    ``verified`` values of ``scope``, in which a review has found it unique; elsewhere, and
    where it is null, the archive and ``locator`` do, and copies in other archives are not found.
    """

    namespace: str
    version: str
    native: str | None
    scope: tuple[str, ...] = ()
    verified: tuple[tuple, ...] = ()
    archive: str = "source_archive_id"
    locator: tuple[str, ...] = ("record_ordinal",)

    def __post_init__(self):
        if any(len(v) != len(self.scope) for v in self.verified):
            raise ValueError("a verified scope has a value for each of its columns")
        if self.verified and self.native is None:
            raise ValueError("a scope is verified for a native identifier")


@dataclass(frozen=True)
class SplitContract(Contract):
    """Split by stable hash of a group; thresholds are upper bounds of buckets of 10,000."""

    contract_id: str = "split-v1"
    salt: str = "salt0"
    group: str = "group_id"
    thresholds: tuple[tuple[str, int], ...] = (("train", 8000), ("validation", 9000), ("test", 10000))
    missing: str = "excluded"


@dataclass(frozen=True)
class DecisionContract(Contract):
    """Which rows of an ordered sequence are decisions, and what an actor sees before them."""

    version: str
    game: str
    position: str
    action: str
    decisions: tuple[str, ...]
    safe: tuple[str, ...]
    history: int = 3
    outcome: tuple[str, ...] = ()
    actor: str | None = None
    #: Default status of records whose reconstruction is as stated by the source.
    level: str = "source_direct"
    unknown_fields: tuple[str, ...] = field(default=())
    #: What the action is aimed at, where the source represents it.
    target: str | None = None
