"""The dataset card, preflight checks and a publication that can be rehearsed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from siltstone.plans.files import verify_manifest

# The sections that a card must have.
SECTIONS = (
    "Description", "Intended uses", "Limitations", "Attribution", "Licences", "No endorsement", "Schema", "Provenance",
    "Build method", "Quality limitations", "Splits", "Citation", "Known biases", "Reconstruction caveats", "Changes to sources",
)


class PublicationRefused(ValueError):
    """The release can't go out as it is."""


def render_card(release: dict, texts: dict[str, str]) -> str:
    """A card with every section; what texts don't give comes from the release record."""
    given = {
        "Licences": "\n".join(f"- {s['source_archive_id']}: {s['license_status']}" for s in release["sources"]),
        "Attribution": "\n".join(f"- {s['original_filename']} {s.get('source_url') or ''}".rstrip() for s in release["sources"]),
        "Schema": "\n".join(f"- {v}: {s}" for v, s in sorted(release["schemas"].items())),
        "Provenance": f"Source catalog {release['catalog_digest']}.",
        "Splits": f"By {release['split_contract']}; no group is in two splits.",
        "Build method": f"Release {release['semantic_release_id']}, build {release['build_audit_id']}.",
        "No endorsement": "No source provider endorses this dataset.",
    } | texts
    lacking = [s for s in SECTIONS if not given.get(s)]
    if lacking:
        raise PublicationRefused(f"the card lacks {lacking}")
    views = "\n".join(f"  - config_name: {v}\n    data_files: {v}/*.parquet" for v in sorted(release["schemas"]))
    head = f"---\nconfigs:\n{views}\nrelease: {release['semantic_release_id']}\n---\n"
    return head + "\n".join(f"\n## {s}\n\n{given[s]}\n" for s in SECTIONS)


def preflight(release: dict, declared: DataFrame, actual: DataFrame, license_holds: DataFrame, card: str, destination: str, allowed: tuple[str, ...]) -> list[str]:
    """What stands against publishing; an empty list means nothing does."""
    found = [f"file {r['path']}: {r['problem']}" for r in verify_manifest(declared, actual).limit(100).collect()]
    found += [f"licence of {r['source_archive_id']} is not verified" for r in license_holds.limit(100).collect()]
    if f"release: {release['semantic_release_id']}" not in card:
        found.append("the card is of another release")
    found += [f"the card lacks {s}" for s in SECTIONS if f"\n## {s}\n" not in card]
    found += [f"view {v} is not configured" for v in release["schemas"] if f"config_name: {v}\n" not in card]
    if destination not in allowed:
        found.append(f"destination {destination} is not allowed")
    return found


def publish(problems: list[str], artifacts: DataFrame, client, destination: str, dry_run: bool = True) -> list[str]:
    """Upload every file through ``client.upload(destination, path)``; a dry run only lists them."""
    if problems:
        raise PublicationRefused("; ".join(problems[:5]))
    paths = [r["path"] for r in artifacts.select("path").orderBy("path").collect()]  # one row a file
    if not dry_run:
        for path in paths:
            client.upload(destination, path)
    return paths


def verify_upload(declared: DataFrame, uploaded: DataFrame) -> DataFrame:
    """Differences between the manifest and what the destination lists."""
    return verify_manifest(declared, uploaded)
