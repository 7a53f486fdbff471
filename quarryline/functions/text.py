"""Text keys, measures and cleanup as column expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sentence pieces shorter or longer than this are tallied and dropped.
UNIT_SHORT, UNIT_LONG = 20, 400


@lru_cache(maxsize=1)
def _decompositions() -> tuple[str, str, list[tuple[str, str]]]:
    """Characters whose compatibility decomposition without marks is one other character, those characters, and the ligatures of letters.

    Made from Unicode's own rule (NFKD), so that folding runs inside Spark's expressions.
    """
    one, to, more = [], [], []
    for code in range(0x80, 0x30000):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4:
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()
        if len(plain) == 1 and plain != c:
            one.append(c)
            to.append(plain)
        elif len(plain) > 1 and plain.isascii() and plain.isalpha() and c.isalpha():
            more.append((c, plain))
    return "".join(one), "".join(to), more


def fold(c: Column | str) -> Column:
    """Lower case without diacritics: NFKD without combining marks, for all scripts."""
    one, to, more = _decompositions()
    c = F.regexp_replace(F.translate(F.lower(_col(c)), one, to), r"\p{M}+", "")
    ligature = "[" + "".join(x for x, _ in more) + "]"
    apart = c
    for x, plain in more:
        apart = F.replace(apart, F.lit(x), F.lit(plain))
    return F.when(c.rlike(ligature), apart).otherwise(c)


def name_key(c: Column | str) -> Column:
    """Join key of a name: trailing parentheses off, folded, letters and digits of any script only."""
    return F.regexp_replace(fold(F.regexp_replace(_col(c), r"\s*\([^)]*\)\s*$", "")), r"[^\p{L}\p{N}]", "")


def plain(c: Column | str) -> Column:
    """Lower case, everything but ASCII letters, digits and spaces a space."""
    return F.regexp_replace(F.lower(_col(c)), "[^a-z0-9 ]", " ")


def plain_joined(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(plain(c), " +", " "))


def plain_quotes(c: Column | str) -> Column:
    """Typographic quotes, dashes and ellipses as plain ones, white space joined."""
    c = F.translate(_col(c), "‘’‚“”„–—−\u00a0", "''\'\"\"\"--- ")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_description(c: Column | str) -> Column:
    """Markup off: comments, references, templates, link targets, emphasis, tags; brackets that explain a foreign spelling."""
    c = F.regexp_replace(_col(c), r"(?s)<!--.*?-->|<ref[^>]*/>|<ref[^>]*>.*?</ref>", "")
    c = F.regexp_replace(c, r"\{\{[^{}]*\}\}", "")
    c = F.regexp_replace(c, r"\[\[(?:[^\]|]*\|)?([^\]|]*)\]\]", "$1")
    c = F.regexp_replace(c, r"'{2,}|<[^>]+>", "")
    c = F.regexp_replace(c, r"\((?=[^()]*[^\x00-\x7F])[^()]*\?\s*\)", "")
    return F.trim(F.regexp_replace(c, "[ \t]+", " "))


def letters_key(c: Column | str) -> Column:
    """Lower case, all but letters and digits of any script removed."""
    return F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{N}]", "")


def split_qualifier(c: Column | str) -> Column:
    """struct(base, qualifier) of ``base (qualifier)``; qualifier is null where there is none."""
    c = _col(c)
    inside = F.regexp_extract(c, r"\(([^()]*)\)\s*$", 1)
    return F.struct(F.trim(F.regexp_replace(c, r"\s*\([^()]*\)\s*$", "")).alias("base"), F.nullif(inside, F.lit("")).alias("qualifier"))


def tokens(c: Column | str, least: int = 1) -> Column:
    """Distinct lower-case words, of letters and digits of any script, of at least ``least`` characters."""
    words = F.split(F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{N}]+", " "), " ")
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= least))


def token_overlap(a: Column, b: Column) -> Column:
    """|A and B| / min(|A|, |B|) of two token arrays; null if either is empty."""
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.least(F.size(a), F.size(b)).cast("double"))


def bigrams(c: Column | str) -> Column:
    """Two-letter pieces of a key, each numbered by occurrence, so that a set intersection counts the multiset's."""
    c = _col(c)
    pieces = F.when(F.length(c) >= 2, F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda k: F.substring(c, k, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    return F.transform(pieces, lambda p, i: F.concat(p, F.size(F.filter(F.slice(pieces, F.lit(1), i + 1), lambda q: q == p)).cast("string")))


def dice(a: Column | str, b: Column | str) -> Column:
    """Dice coefficient of the two keys' bigram multisets."""
    x, y = bigrams(a), bigrams(b)
    return F.coalesce(F.try_divide(2.0 * F.size(F.array_intersect(x, y)), (F.size(x) + F.size(y)).cast("double")), F.lit(0.0))


def digits_differ(a: Column | str, b: Column | str) -> Column:
    """True if the digits of the two names are not the same multiset."""
    sort = lambda c: F.array_sort(F.split(F.regexp_replace(_col(c), "[^0-9]", ""), ""))
    return sort(a) != sort(b)


def entropy(c: Column | str) -> Column:
    """Shannon entropy in bits a character; null for empty text."""
    c = _col(c)
    n = F.length(c)
    letters = F.array_distinct(F.split(c, ""))
    share = lambda ch: (n - F.length(F.replace(c, ch, F.lit("")))).cast("double") / n
    return F.when(n > 0, F.aggregate(letters, F.lit(0.0), lambda s, ch: s - F.when(F.length(ch) > 0, share(ch) * F.log2(share(ch))).otherwise(0.0)))


def sentences(c: Column | str) -> Column:
    """Pieces of a text after '.', '!' or '?' and white space, or at line ends; trimmed, none empty."""
    marked = F.regexp_replace(F.regexp_replace(_col(c), r"([.!?])[ \t]+", "$1\n"), "\n+", "\n")
    return F.filter(F.transform(F.split(marked, "\n"), lambda s: F.trim(s)), lambda s: F.length(s) > 0)


def opener(c: Column | str, words: int = 4) -> Column:
    """The first ``words`` words, lower case."""
    return F.array_join(F.slice(F.filter(F.split(F.lower(_col(c)), "[ \t\n\r]+"), lambda w: F.length(w) > 0), 1, words), " ")


def slug(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), "^-|-$", "")


def singular(c: Column | str) -> Column:
    """Conservative: ies to y, (s|x|z|ch|sh)es to its stem, s off unless after s, u or i."""
    c = _col(c)
    return (
        F.when(c.rlike("[^aeiou]ies$"), F.regexp_replace(c, "ies$", "y"))
        .when(c.rlike("(s|x|z|ch|sh)es$"), F.regexp_replace(c, "es$", ""))
        .when(c.rlike("[^sui]s$"), F.regexp_replace(c, "s$", ""))
        .otherwise(c)
    )


def html_text(c: Column | str) -> Column:
    """Readable text of a page: scripts, styles and tags off, the common references decoded, white space joined."""
    c = F.regexp_replace(_col(c), r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    c = F.regexp_replace(c, "<[^>]*>", " ")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(c, "[ \t\r\n]+", " "))


def url_host(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(c), "^[a-z]+://([^/:?#]+)", 1), F.lit(""))


def registrable(host: Column | str) -> Column:
    """The last two labels of a host name."""
    return F.substring_index(_col(host), ".", -2)


def stored_cut(c: Column | str, limit: int) -> Column:
    """Text cut at ``limit`` with a marker that says how much is gone."""
    c = _col(c)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(" [+"), (F.length(c) - limit).cast("string"), F.lit(" chars]"))).otherwise(c)


def estimate_tokens(c: Column | str, chars_per_token: float = 4.0) -> Column:
    return F.ceil(F.length(_col(c)) / F.lit(chars_per_token)).cast("long")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
