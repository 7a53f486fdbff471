"""Row gates: evidence, names, spans, tiers and bands as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarryline.functions import rules as K
from quarryline.functions.numeric import band, log_score
from quarryline.functions.text import entropy


#: The name and sign of a credential assignment, and its value.
SECRET_VALUE = K.SECRET_ASSIGN.replace(r"([^\s\"',}]{16,})", r"[^\s\"',}]{16,}").replace(r"\b[a-z0-9_\-]*(?:", r"(\b[a-z0-9_\-]*(?:", 1).replace(r"[\"']?[^\s", r"[\"']?)[^\s", 1)


def act_upon_object(c: Column) -> Column:
    """An act and an object that starts within the proximity before the act's start or after its end."""
    near = f"(?:.{{0,{K.PROXIMITY}}})"
    return c.rlike(f"(?is){K.ACT}{near}{K.OBJECT}") | c.rlike(f"(?is)(?={K.OBJECT}){near}{K.ACT}")


def evidence_reason(c: Column) -> Column:
    """Why a note shows no scale, or null if it does: short, mechanics, no deed, passive, reputation."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return (
        F.when(F.length(t) < 8, "short").when(t.rlike(K.STATBLOCK), "mechanics").when(t.rlike(K.MAGNITUDE), None)
        .when(~act_upon_object(t), "no deed").when(t.rlike(K.PATIENT), "passive").when(t.rlike(K.REPUTATION), "reputation")
    )


def needs_rephrase(c: Column) -> Column:
    return c.rlike(K.SETTING_META)


def well_formed(c: Column) -> Column:
    """A sayable name: 4 to 11 letters, no piece of three letters twice, no doubled syllable, no run of
    three vowels or consonants, no consonant more than twice, two vowels at least."""
    n = F.lower(c)
    consonant = "[^aeiouy]"
    return (
        F.length(n).between(*K.NAME_LETTERS)
        & ~n.rlike("(...).*\\1") & ~n.rlike("(?=(..(.)).).\\1") & ~n.rlike("(..)\\1") & ~n.rlike(f"{consonant}{{3}}") & ~n.rlike("[aeiouy]{3}")
        & ~n.rlike(f"({consonant}).*\\1.*\\1") & (F.regexp_count(n, F.lit("[aeiouy]")) >= 2)
    )


def sentence_like(c: Column, most_words: int = 8) -> Column:
    """Why a span is prose and no name, or null."""
    t = F.trim(c)
    return F.when(t == "", "empty").when(t.rlike("[.!?:]$"), "punctuation").when(F.size(F.split(t, r"\s+")) > most_words, "long")


def clean_band(c: Column) -> Column:
    """M0 to M10 in full, whatever its case, or ``unassayed``."""
    return F.coalesce(F.nullif(F.regexp_extract(F.upper(F.trim(c)), "^(M(?:10|[0-9]))$", 1), F.lit("")), F.lit("unassayed"))


def axis_score(x: Column, band_name: Column, axis: str) -> Column:
    """Score of a quantity within its band on one axis, two places; the top band saturates."""
    floors = K.FLOORS[axis]
    out = F.lit(None).cast("double")
    for k, name in enumerate(K.LADDER):
        if k + 1 < len(floors):
            value = F.bround(log_score(x, F.lit(floors[k]), F.lit(floors[k + 1])), 2)
        else:
            value = F.when(x >= floors[k], K.TOP_SCORE).when(x > 0, 0.0)
        out = F.when(band_name == name, value).otherwise(out)
    return out


def band_of(x: Column, axis: str) -> Column:
    k = band(x, K.FLOORS[axis])
    return F.when(k.isNotNull(), F.concat(F.lit("M"), k.cast("string")))


def composite(scores: Mapping[str, Column], anchor: Column) -> Column:
    """Band number plus a tenth of the weighted mean of the axes that have a score."""
    used = sum((F.when(s.isNotNull(), F.lit(K.WEIGHTS[a])).otherwise(0.0) for a, s in scores.items()), F.lit(0.0))
    total = sum((F.coalesce(s * K.WEIGHTS[a], F.lit(0.0)) for a, s in scores.items()), F.lit(0.0))
    return F.substring(anchor, 2, 2).cast("int") + F.try_divide(total, used) / 10.0


def tier(count: Column) -> Column:
    out = F.lit(K.TIERS[0][0])
    for name, floor in K.TIERS[1:]:
        out = F.when(count >= floor, name).otherwise(out)
    return out


def tier_rank(name: Column) -> Column:
    out = F.lit(None).cast("int")
    for k, (n, _) in enumerate(K.TIERS):
        out = F.when(name == n, k).otherwise(out)
    return out


def promoted(current: Column, count: Column) -> Column:
    """Tiers only rise; an unknown tier is repaired to the earned one."""
    earned = tier(count)
    return F.when(F.coalesce(tier_rank(current), F.lit(-1)) >= tier_rank(earned), current).otherwise(earned)


def real_secret(c: Column) -> Column:
    """A provider-shaped credential, or an assigned value that is random enough."""
    value = F.regexp_extract(c, K.SECRET_ASSIGN, 1)
    return c.rlike(K.SECRET) | ((value != "") & (entropy(value) >= K.SECRET_ENTROPY_BITS))


def scrub(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, K.SECRET, "[REDACTED]"), SECRET_VALUE, "$1[REDACTED]")


def cohort(code: Column) -> Column:
    """The two-part family of a shelf code; null for one part."""
    return F.when(F.size(F.split(code, "[.]")) >= 2, F.substring_index(code, ".", 2))


def designator(c: Column) -> Column:
    """Head of a name's parenthetical, lower case, null if it is not 2 to 39 letters long."""
    head = F.lower(F.trim(F.split_part(F.regexp_extract(c, r"\(([^)]*)\)", 1), F.lit("/"), F.lit(1))))
    return F.when(F.length(head).between(2, 39), head)
