"""Text expressions: tokens, phrases, identifiers, embedding texts and the health of
extracted text.  All are column expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMBED_CHARS = 6000
SNIPPET_CHARS = 200


def snippet(body: Column) -> Column:
    return F.substring(body, 1, SNIPPET_CHARS)


def simple_tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def simple_phrase_count(text: Column, phrase: list[str]) -> Column:
    """``phrase_count`` over ``simple_tokens`` in one pass of a regular expression: the
    first token is consumed, the others are looked ahead at, so overlaps count."""
    if not phrase:
        return F.lit(0)
    word, gap = r"[\p{L}\p{N}]", r"[^\p{L}\p{N}]+"
    rest = "".join(gap + t for t in phrase[1:])  # tokens are letters and digits only
    return F.regexp_count(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"(?<!{word}){phrase[0]}(?={rest}(?!{word}))"))


def phrase_count(tokens: Column, phrase: list[str]) -> Column:
    """At how many positions the tokens of the phrase stand at the phrase's distances.  A
    blank token of the phrase is the place of a stop word: any token may stand there, and
    at the ends it asks for nothing.  A phrase of blanks alone is nowhere."""
    wanted = [(i, t) for i, t in enumerate(phrase) if t]
    if not wanted:
        return F.lit(0)
    first, last = wanted[0][0], wanted[-1][0]
    spots = F.sequence(F.lit(1), F.greatest(F.size(tokens) - (last - first), F.lit(1)))

    def stands(i: Column) -> Column:
        fits = F.lit(True)
        for at, t in wanted:
            fits = fits & F.coalesce(F.get(tokens, i - 1 + (at - first)) == t, F.lit(False))
        return fits

    return F.size(F.filter(spots, stands))


def flat(text: Column) -> Column:
    """Line breaks to spaces, spaces and tabs trimmed; null is empty."""
    return F.trim(F.translate(F.coalesce(text, F.lit("")), "\n\r", "  "), F.lit(" \t"))


def works_text(title: Column, abstract: Column) -> Column:
    parts = F.filter(F.array(flat(title), flat(abstract)), lambda p: p != "")
    return F.substring(F.array_join(parts, " "), 1, EMBED_CHARS)


def page_text(body: Column) -> Column:
    return F.substring(F.translate(F.coalesce(body, F.lit("")), "\n\r", "  "), 1, EMBED_CHARS)


def normalize_title(title: Column) -> Column:
    """Letters and digits of a title, for comparing: no TeX commands, no case, ё as е."""
    bare = F.regexp_replace(F.replace(F.coalesce(title, F.lit("")), F.lit("$"), F.lit(" ")), r"\\[a-zA-Z]+", " ")
    return F.regexp_replace(F.translate(F.lower(bare), "ё", "е"), "[^0-9a-zа-я]", "")


def doi_suffix(doi: Column) -> Column:
    tidy = F.rtrim(F.lower(F.trim(F.coalesce(doi, F.lit("")))), F.lit(".,"))
    return F.substring_index(tidy, "/", -1)


def normalize_doi(doi: Column) -> Column:
    """Lower case, without the two resolver prefixes and without ``.`` and ``,`` at the end."""
    bare = F.lower(F.trim(F.coalesce(doi, F.lit(""))))
    for prefix in ("https://doi.org/", "http://dx.doi.org/"):  # fixed values
        bare = F.replace(bare, F.lit(prefix), F.lit(""))
    return F.rtrim(bare, F.lit(".,"))


def short_id(url: Column) -> Column:
    return F.substring_index(F.rtrim(F.coalesce(url, F.lit("")), F.lit("/")), "/", -1)


def mathnet_id(url: Column, host: str = "mathnet.ru") -> Column:
    """Last part of a URL of the host, null for other URLs."""
    return F.when(F.contains(url, F.lit(host)), F.nullif(short_id(url), F.lit("")))


def safe_id(name: Column) -> Column:
    return F.regexp_replace(name, "[^A-Za-z0-9_-]", "_")


def year_matches(year: Column, years: Column, span: int = 1) -> Column:
    """True where no year is known; false where only the candidate's is missing."""
    known = F.filter(F.coalesce(years, F.array().cast("array<int>")), lambda y: y.isNotNull() & (y != 0))
    return F.when(F.size(known) == 0, True).when(year.isNull(), False).otherwise(F.exists(known, lambda y: F.abs(year - y) <= span))


def restore_abstract(inverted: Column) -> Column:
    """Text from a map word -> positions; gaps in the positions are ignored."""
    pairs = F.flatten(F.transform(F.map_entries(inverted), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.array_join(F.transform(F.array_sort(pairs), lambda x: x["w"]), " ")


def journal_fields(reason: Column) -> dict[str, Column]:
    """The machine-readable facts in a journal row's prose; NULL where absent."""
    def got(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(reason, pattern, 1), F.lit(""))

    return {
        "node_key": F.coalesce(got("node=([^ ]+)"), got("seed=([^ ]+)")),
        "score": got(r"score=(-?[0-9.]+)").cast("double"),
        "tau": got(r"tau=(-?[0-9.]+)").cast("double"),
        "relation": got("relation=([a-z]+)"),
        "cited_by_count": got("cited_by_count=([0-9]+)").cast("long"),
    }


# Shares and counts at which extracted text changes its class.
CYRILLIC_CLEAN, LATIN_STRAY, FEWEST_LETTERS, DENSE_ENOUGH = 0.30, 0.003, 50, 0.30


def _many(text: Column, letters: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{letters}]", ""))


def letter_stats(text: Column) -> dict[str, Column]:
    cyrillic, supplement, ascii_ = _many(text, r"Ѐ-ӿ"), _many(text, r"À-ÿ"), _many(text, "a-zA-Z")
    other = F.length(F.regexp_replace(text, r"[^\p{L}]|[Ѐ-ӿÀ-ÿa-zA-Z]", ""))
    return {"cyrillic": cyrillic, "latin1_supplement": supplement, "ascii_letters": ascii_, "other_letters": other}


def letter_density(text: Column) -> Column:
    solid = F.regexp_replace(text, r"\s", "")
    return F.when(F.length(solid) == 0, 0.0).otherwise(_many(solid, r"\p{L}") / F.length(solid))


def cp1251_pairs() -> tuple[str, str]:
    """Characters U+0080 to U+00FF, and what cp1251 has at those bytes; bytes that it
    leaves open are left out."""
    wrong, right = "", ""
    for b in range(0x80, 0x100):
        c = bytes([b]).decode("cp1251", "ignore")
        if c:
            wrong, right = wrong + chr(b), right + c
    return wrong, right


def recover_mojibake(text: Column) -> Column:
    return F.translate(text, *cp1251_pairs())


def classify_text(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with category and recovered: the text, repaired where the repair makes
    Cyrillic dominant.  Counts are columns of their own, so each is computed once."""
    def counted(of: DataFrame, column: str, prefix: str) -> DataFrame:
        return of.withColumns({f"_{prefix}_{n}": c for n, c in letter_stats(F.col(column)).items()})

    def total(prefix: str) -> Column:
        return sum((F.col(f"_{prefix}_{n}") for n in ("latin1_supplement", "ascii_letters", "other_letters")), F.col(f"_{prefix}_cyrillic"))

    def share(prefix: str, name: str) -> Column:
        return F.when(total(prefix) == 0, 0.0).otherwise(F.col(f"_{prefix}_{name}") / total(prefix))

    both = counted(rows.withColumn("_fixed", recover_mojibake(F.col(text_col))), text_col, "raw")
    both = counted(both, "_fixed", "fix").withColumn("_dense", letter_density(F.col(text_col)))
    category = (
        F.when(total("raw") < FEWEST_LETTERS, "no_text_layer")
        .when(share("raw", "cyrillic") >= CYRILLIC_CLEAN, "clean")
        .when(share("raw", "latin1_supplement") <= LATIN_STRAY, "clean")
        .when(share("fix", "cyrillic") >= CYRILLIC_CLEAN, "mojibake_recovered")
        .when(F.col("_dense") >= DENSE_ENOUGH, "degraded")
        .otherwise("broken")
    )
    both = both.withColumn("category", category)
    return both.select(*rows.columns, "category", F.when(F.col("category") == "mojibake_recovered", F.col("_fixed")).otherwise(F.col(text_col)).alias("recovered"))


def extraction_state(category: Column) -> Column:
    states = {"clean": "clean", "mojibake_recovered": "recoded", "degraded": "degraded", "broken": "unreadable", "no_text_layer": "unreadable"}
    return F.element_at(F.create_map(*(F.lit(x) for pair in states.items() for x in pair)), category)
