"""Row status, shapes and stamps of catalogue entries and stored results, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarryline.functions.text import fold

#: Magnitudes that claim nothing (fixed values).
NO_CLAIM = ("unassayed", "none", "n/a")
#: Reasons that make a refusal a result (fixed values).
FINAL_REASONS = ("no axis cleared its gate", "sheet saturated")
#: Words that stand for a person in a sentence (fixed values).
PRONOUNS = ("he", "she", "they", "his", "her", "their", "him", "himself", "herself", "themselves")


def entry_settled(catalogued: Column, excluded: Column) -> Column:
    """An entry is finished with: judged, or struck."""
    return F.coalesce(catalogued, F.lit(False)) | excluded.isNotNull()


def entry_live(excluded: Column, stale_since: Column) -> Column:
    return excluded.isNull() & stale_since.isNull()


def stale_held_out(excluded: Column, stale_since: Column) -> Column:
    """Not struck, but left out because its page is stale."""
    return excluded.isNull() & stale_since.isNotNull()


def result_settled(decimal: Column, status: Column, reason: Column) -> Column:
    """A stored result is a finding: it has a value, or a refusal that names the evidence and not the transport."""
    final = F.lit(False)
    for text in FINAL_REASONS:
        final = final | F.contains(F.coalesce(reason, F.lit("")), F.lit(text))
    return F.when(decimal.isNotNull(), True).when(status.eqNullSafe("DEFERRED"), False).otherwise(final)


def asserts_magnitude(magnitude: Column) -> Column:
    low = F.lower(F.trim(F.coalesce(magnitude, F.lit(""))))
    return (low != "") & ~low.isin(*NO_CLAIM)


def banned_terms(text: Column, pattern: str) -> Column:
    """The distinct terms found, lower case and sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda t: F.lower(t))))


def rows_well_shaped(body: Column, field: str, strings: Sequence[str]) -> Column:
    """The JSON body is an object whose ``field`` is a list of objects, and each named member is a string, null or absent."""
    parsed = F.try_parse_json(body)
    kind = lambda v: F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
    rows = F.try_variant_get(parsed, f"$.{field}", "array<variant>")

    def good(row: Column) -> Column:
        ok = kind(row).startswith("OBJECT")
        for name in strings:
            ok = ok & kind(F.try_variant_get(row, f"$.{name}", "variant")).isin("STRING", "VOID")
        return ok

    return F.coalesce(F.forall(rows, good), F.lit(False))


def names_subject(sentence: Column, entity: Column) -> Column:
    """The entity, or a pronoun, is what the sentence speaks of.

    A word of the entity's name of more than three letters must start a word of the sentence; a name
    without such words must stand whole; accents do not count.
    """
    return names_folded(fold(sentence), fold(entity))


def names_folded(low: Column, name: Column) -> Column:
    """``names_subject`` of a sentence and a name that are folded already, so that a text can be folded once before it is cut into sentences."""
    words = F.filter(F.split(name, r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) > 0)
    parts, phrase = F.filter(words, lambda w: F.length(w) > 3), F.array_join(words, " ")
    spoken = F.concat(F.lit(" "), F.regexp_replace(low, r"[^\p{L}\p{N}_]+", " "), F.lit(" "))  # each word after a space
    by_part = F.exists(parts, lambda p: F.contains(spoken, F.concat(F.lit(" "), p)))
    whole = (F.size(parts) == 0) & (phrase != "") & F.rlike(spoken, F.concat(F.lit(" \\Q"), phrase, F.lit("\\E( ?s)? ")))
    pronoun = low.rlike(f"(?<![a-z])(?:{'|'.join(PRONOUNS)})(?![a-z])")
    return F.coalesce(pronoun | by_part | whole, F.lit(False))


def category_path(category: Column, topic: Column, subroom: Column, parents: Mapping[str, str]) -> Column:
    """The rooms of an entry, coarsest first; ``parents`` maps each finer room to the room it must lie in."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    long_form = blank(category)
    coarse = F.coalesce(F.nullif(F.trim(F.substring_index(long_form, "(", 1)), F.lit("")), long_form)
    finer = F.lit(None).cast("string")
    for c in (topic, subroom):  # a subroom decides before a topic
        for room, parent in parents.items():
            finer = F.when((blank(c) == room) & (coarse == parent), F.lit(room)).otherwise(finer)
    return F.when(coarse.isNull(), F.array_compact(F.array(blank(topic)))).otherwise(F.array_compact(F.array(coarse, finer)))


def chunk_key(host: Column, entity: Column, text: Column) -> tuple[Column, Column]:
    """(folder, name) of an answer: two and sixteen hex digits of a digest of host, entity and passage."""
    digest = F.sha2(F.concat(host, F.lit(chr(31)), F.coalesce(entity, F.lit("")), F.lit(chr(31)), text), 256)
    return F.left(digest, F.lit(2)), F.substring(digest, 3, 16)


def stamp_state(stamped_entries: Column, stamped_digest: Column, entries: Column, digest: Column) -> Column:
    return F.when(stamped_digest.isNull(), "UNSTAMPED").when((stamped_entries == entries) & (stamped_digest == digest), "OK").otherwise("DRIFTED")


def floor_state(measured: Column, bar: Column) -> Column:
    """A floor that only moves down: the first measurement sets it, growth past it fails."""
    return F.when(bar.isNull(), "baseline").when(measured > bar, "REGRESSED").when(measured < bar, "ratcheted").otherwise("held")


def band_tier(band: Column) -> tuple[Column, Column]:
    """(tier 0 to 10, how it was read) of a band such as ``M3`` or ``A M3.52``: the number's head, not its digits."""
    number = F.regexp_extract(band, r"M\s*([0-9]+)", 1)
    open_ = band.isNull() | (band == "unassayed")
    value = F.try_to_number(F.nullif(number, F.lit("")), F.lit("999999")).cast("int")
    how = F.when(open_, "unassayed").when(number == "", "unparsed").when(value > 10, "out_of_range").otherwise("ok")
    return F.when(how.isin("unassayed", "unparsed"), 0).otherwise(F.least(value, F.lit(10))), how


def where_spans(where: Column) -> Column:
    """array<struct<file, first, last>> of the source places that a text names; ``src/`` is the default folder, other folders count."""
    slashed = F.replace(where, F.lit("\\"), F.lit("/"))
    found = F.regexp_extract_all(slashed, F.lit(r"[A-Za-z0-9_./]*[A-Za-z0-9_]+\.py(?::[0-9]+(?:-[0-9]+)?)?"), F.lit(0))

    def span(x: Column) -> Column:
        numbers = F.split(F.regexp_extract(x, ":([0-9]+(?:-[0-9]+)?)$", 1), "-")
        number = lambda k: F.nullif(F.coalesce(F.get(numbers, F.lit(k)), F.lit("")), F.lit("")).cast("int")
        a, z = number(0), F.coalesce(number(1), number(0))
        return F.struct(F.regexp_replace(F.regexp_replace(x, ":[0-9-]+$", ""), "^src/", "").alias("file"), F.least(a, z).alias("first"), F.greatest(a, z).alias("last"))

    return F.array_distinct(F.transform(found, span))
