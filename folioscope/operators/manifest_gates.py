"""What must hold of a package's manifest before anything else of the package is read.
Each gate makes the next one meaningful, so the first that fails is the whole answer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators.publish import CONTENT, DISTRIBUTIONS, SHIPPED

# The profiles, and what a manifest of each may list.
PROFILES = ("public", "full")
LISTS = {
    "shipped_distributions": {"public": SHIPPED, "full": DISTRIBUTIONS},
    "full_content_distributions": {"public": CONTENT, "full": CONTENT},
}


def _vocabulary(manifest: dict) -> str:
    """Lists that are empty or name a class the profile can't carry; either would shrink
    what the later checks look for."""
    legal = manifest.get("legal")
    if not isinstance(legal, dict):
        return "legal is no block"
    wrong = []
    for name, allowed in LISTS.items():
        listed = legal.get(name) or []
        strange = sorted(set(listed) - set(allowed[manifest["profile"]]))
        if strange or not listed:
            wrong.append(f"{name}: {', '.join(strange) or 'empty'}")
    return "; ".join(wrong)


def _dump_named(manifest: dict) -> str:
    dump = manifest.get("dump")
    return "" if isinstance(dump, dict) and isinstance(dump.get("file"), str) and dump["file"] else "dump names no file"


def _dump_as_declared(manifest: dict, files: DataFrame) -> str:
    dump = manifest["dump"]
    found = files.filter(F.col("name") == dump["file"]).select("bytes", "sha256").first()
    if found is None:
        return f"{dump['file']} isn't there"
    differ = [f"{c} {found[c]} for {dump.get(c)}" for c in ("bytes", "sha256") if found[c] != dump.get(c)]
    return f"{dump['file']}: {differ[0]}" if differ else ""


def manifest_gates(manifest: dict, files: DataFrame, version: int) -> list[tuple[str, bool, str]]:
    """(gate, ok, detail) up to and with the first gate that fails.  files (name, bytes,
    sha256) are what the package holds; they are asked only by the last gate."""

    def gates() -> Iterator[tuple[str, Callable[[], str]]]:
        yield "version", lambda: "" if manifest.get("schema_version") == version else f"version {manifest.get('schema_version')!r}, {version} is read here"
        yield "profile", lambda: "" if manifest.get("profile") in PROFILES else f"unknown profile {manifest.get('profile')!r}"
        yield "vocabulary", lambda: _vocabulary(manifest)
        yield "citation", lambda: "" if isinstance(manifest.get("citation"), dict) else "citation is no block"
        yield "dump", lambda: _dump_named(manifest)
        yield "dump-intact", lambda: _dump_as_declared(manifest, files)

    out = []
    for name, problem in gates():
        detail = problem()
        out.append((name, not detail, detail))
        if detail:
            break
    return out
