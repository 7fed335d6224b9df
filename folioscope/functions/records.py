"""Expressions over source records: identifiers, titles, authors, evidence, cached pages
and file names.  A record is a struct, or JSON text inside a node's evidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.text import normalize_doi, short_id

# The identifier fields of a record, and what a filter's first part asks for.
ID_FIELDS = ("openalex", "doi", "mag", "pmid", "pmcid")
DIRECTIONS = {"referenced_works": "cites", "cites": "cites", "ids.openalex": "openalex_id", "openalex_id": "openalex_id"}

RECORDS = "records array<struct<id: string, title: string, cited_by_count: bigint, referenced_works_count: bigint>>"
PAGE = "meta struct<count: long, x_query: struct<url: string, oql: string>>"


def blank_to_null(text: Column) -> Column:
    """Trimmed text, null where nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def record_ids(ids: Column, own_id: Column, doi: Column) -> Column:
    """Every identifier a record claims as ``namespace:value``, sorted, each once."""

    def named(space: str, value: Column, tidy) -> Column:
        return F.concat(F.lit(f"{space}:"), F.nullif(tidy(value), F.lit("")))

    claims = [named(f, ids[f], normalize_doi if f == "doi" else short_id) for f in ID_FIELDS]
    claims += [named("openalex", own_id, short_id), named("doi", doi, normalize_doi)]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*claims))))


def external_ids(aliases: Column) -> Column:
    """Namespace -> sorted values of ``namespace:value`` aliases."""
    space = lambda a: F.substring_index(a, ":", 1)
    ordered = F.array_sort(F.array_distinct(aliases))
    spaces = F.array_distinct(F.transform(ordered, space))
    values = lambda s: F.transform(F.filter(ordered, lambda a: space(a) == s), lambda a: F.substr(a, F.length(s) + 2))
    return F.map_from_arrays(spaces, F.transform(spaces, values))


def record_title(title: Column, display_name: Column) -> Column:
    """The first that isn't blank, trimmed."""
    return F.coalesce(blank_to_null(title), blank_to_null(display_name))


def record_authors(authorships: Column) -> Column:
    """Names in order: the author's display name, or the name as printed."""
    names = F.transform(authorships, lambda a: F.coalesce(F.nullif(a["author"]["display_name"], F.lit("")), F.nullif(a["raw_author_name"], F.lit(""))))
    return F.coalesce(F.array_compact(names), F.array().cast("array<string>"))


def records_of(evidence: Column) -> Column:
    """The source records inside a node's evidence (JSON text)."""
    return F.from_json(evidence, RECORDS)["records"]


def summed(records: Column, field: str) -> Column:
    """Sum of a counter over nested records; no record adds nothing."""
    return F.aggregate(F.coalesce(records, F.array()), F.lit(0).cast("long"), lambda a, r: a + F.coalesce(r[field], F.lit(0)))


def evidence(records: Column, relation: Column, discovered_from: Column, score: Column, abstract_source: Column, zbmath_id: Column) -> Column:
    """What is known of a node, as JSON text: empty parts are left out, the score has six
    places, half to even."""
    given = lambda c: F.nullif(c, F.lit(""))
    parts = F.struct(
        records.alias("records"), given(abstract_source).alias("abstract_source"), given(zbmath_id).alias("zbmath_id"), given(relation).alias("relation"),
        given(discovered_from).alias("discovered_from"), F.bround(score, 6).alias("frontier_score"),
    )
    return F.to_json(parts)


def direction_of(filter_value: Column) -> Column:
    """What a ``filter=`` value asks for; null for any other filter."""
    known = F.create_map(*(F.lit(x) for pair in DIRECTIONS.items() for x in pair))
    return F.get(F.array(known[F.substring_index(filter_value, ":", 1)]), 0)


def filter_value(url: Column) -> Column:
    tail = F.when(F.instr(url, "filter=") > 0, F.substring_index(F.substr(url, F.instr(url, "filter=") + 7), "&", 1))
    return F.coalesce(tail, F.lit(""))


def page_index(body: Column) -> dict[str, Column]:
    """filter, direction, oql and count of a cached page (JSON text).  A batch is known by
    its filter, which all its pages share, and not by the url, which holds a cursor."""
    meta = F.from_json(body, PAGE)["meta"]
    url, oql = (F.coalesce(meta["x_query"][c], F.lit("")) for c in ("url", "oql"))
    value = filter_value(url)
    name = F.coalesce(F.nullif(value, F.lit("")), F.nullif(oql, F.lit("")), url)
    return {"filter": name, "direction": direction_of(value), "oql": oql, "count": F.coalesce(meta["count"], F.lit(0).cast("long"))}


def note_direction(direction: Column, filter_name: Column, has_direction: Column) -> Column:
    """The direction an index states, or what its filter says where it states none."""
    return F.when(has_direction, direction).otherwise(direction_of(F.coalesce(filter_name, F.lit(""))))


def entry_name(model: Column, text: Column) -> Column:
    """File name of a memoised vector: the model, made safe for a path, and the digest."""
    return F.concat(F.regexp_replace(model, "[^A-Za-z0-9._-]", "_"), F.lit("-"), F.sha2(text, 256), F.lit(".json"))


def path_verdict(path: Column, registry: str = "SOURCES.md") -> Column:
    """What becomes of a file by its path; the first rule that fits decides."""
    rules = [
        (path.startswith("iis/wiki/"), "exclude"),
        (path.rlike(r"^iis/[^/\n]+\.pdf$"), "include-pdf"),
        (path.rlike(r"^iis/[^/\n]+\.djvu$"), "include-djvu"),
        (path.isin("iis/INDEX.md", "iis/THEMES.md", f"external/{registry}"), "include-metadata"),
        (path.rlike(r"^external/[^/\n]+\.(pdf|md)$"), "include-external"),
    ]
    out = F.lit("unclassified")
    for fits, verdict in reversed(rules):
        out = F.when(fits, verdict).otherwise(out)
    return out


def report_cell(text: Column, chars: int = 70) -> Column:
    """Text for a cell of a report table: cut, with the cell's own mark escaped."""
    return F.replace(F.substring(F.coalesce(text, F.lit("")), 1, chars), F.lit("|"), F.lit("\\|"))


def pretty_size(size: Column) -> Column:
    """Bytes up to 10239, then the largest of kB, MB, GB and TB that shows under 10240."""
    out = F.concat(F.round(size / 1024**4).cast("long").cast("string"), F.lit(" TB"))
    for power, unit in ((3, "GB"), (2, "MB"), (1, "kB")):
        shown = F.round(size / 1024**power)
        out = F.when(shown < 10240, F.concat(shown.cast("long").cast("string"), F.lit(f" {unit}"))).otherwise(out)
    return F.when(size < 10240, F.concat(size.cast("string"), F.lit(" bytes"))).otherwise(out)


def fresh(fetched_at: Column, days: int, now: Column | None = None) -> Column:
    """Fetched less than ``days`` ago (strictly)."""
    return fetched_at > (F.current_timestamp() if now is None else now) - F.make_dt_interval(F.lit(days))
