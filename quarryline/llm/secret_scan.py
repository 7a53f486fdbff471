"""Secret scan: candidates by pattern, false positives removed by a random forest.

Everything runs in DataFrame expressions and Spark ML. A text is split at its candidates, which gives
each candidate its left and right neighbours in two passes of the same regular expression. The forest
sees the candidate's length and alphabet; its character transitions, as changes of class and as the mean
log-likelihood of its letter pairs under the corpus's own words; its dictionary coverage, the share
of it that is words of the corpus's dictionary (the words of ``LEAST_DOCS`` documents or more); and, hashed,
the words to its left and right and the parts of its path. Dictionary and transitions come from all
documents (``language``). Features of the value alone are computed once for each distinct value.

Labelled findings come as a table (``candidate, value, left, right, path, label``). No table of real ones
exists here, so ``labelled_findings`` draws one: credentials of several shapes against checksums,
identifiers, numbers and placeholders, in contexts that are likelier for one class but occur in both, so
that no single feature decides. Tests measure precision and recall on fresh draws and on planted secrets.

Defined cases: a null or empty text has no candidates; a null path counts as empty; repeated rows are
scanned each; an empty table gives an empty result; with no dictionary nothing is covered; further
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.llm.shared import cut

#: Characters of context on either side, and the words of it that count.
CONTEXT, NEIGHBOURS = 48, 3
TREES = 40
DEPTH = 8
#: Slots for the hashed words and path parts.
HASHED = 64
#: Documents in which a word of the dictionary stands.
LEAST_DOCS = 5
#: Rows of the drawn training table, rows of any training table that are used at most, and words that it is drawn from.
RULE_ROWS = 4000
MOST_ROWS = 50_000
DRAWN_WORDS = 200

_NAME = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)"
_ASSIGNED = rf"(?i:{_NAME})[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?[^\s\"'<>]{{6,}}"
_LOOSE = r"(?<![A-Za-z0-9+/_=\-])(?=[A-Za-z+/_=\-]*+[0-9])[A-Za-z0-9+/_=\-]{16,}"
_KEY_BLOCK = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
CANDIDATE = rf"{_ASSIGNED}|{_KEY_BLOCK}|{_LOOSE}"
_VALUE = rf"^(?i:{_NAME})[\"']?\s*[=:]\s*[\"']?([^\s\"'<>]+)$"

# Words for drawn identifiers where the corpus has none.
WORDS = "user name type value data file path list item index count time date page text line code default config module class function object string number size version update".split()
PLACEHOLDER = r"(?i)xxx|your|changeme|placeholder|example|dummy|<|\$\{|\*{3}|(.)\1{5}"

FEATURES = [
    "f_length", "f_changes", "f_pairs", "f_covered", "f_digits", "f_upper", "f_lower", "f_symbols", "f_hex", "f_distinct",
    "f_named", "f_assigned", "f_quoted", "f_placeholder", "f_plain_number",
]


@dataclass
class Language:
    """dictionary: word; transitions: pair (two letters), logp; common: some frequent words."""

    dictionary: DataFrame
    transitions: DataFrame
    common: list[str]


def language(docs: DataFrame) -> Language:
    """Dictionary and letter transitions of all documents; words are counted map-side and only the dictionary's go on."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?<![\p{L}\p{N}_])[a-z]{3,20}(?![\p{L}\p{N}_])"), F.lit(0)))
    counted = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_DOCS)
    counted = cut(counted, "dictionary")
    pairs = counted.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda k: F.substring(F.col("word"), k, F.lit(2)))).alias("pair"))
    pairs = pairs.groupBy("pair").agg(F.sum("n").alias("n"))  # at most 26 * 26 rows
    first = pairs.groupBy(F.left("pair", F.lit(1)).alias("c")).agg(F.sum("n").alias("all"))
    transitions = pairs.join(first, F.left("pair", F.lit(1)) == F.col("c")).select("pair", F.log((F.col("n") + 1) / (F.col("all") + 26)).alias("logp"))
    common = [r.word for r in counted.where("length(word) > 3").orderBy(F.desc("n"), "word").limit(DRAWN_WORDS).collect()]
    return Language(counted.select("word"), cut(transitions, "transitions"), common)


def candidates(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n (the candidate's number in its text), candidate, value, left, right, path."""
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    hit = docs.select("doc_id", "text", where.alias("path")).where(F.col("text").rlike(CANDIDATE))
    cut_up = hit.select("doc_id", "path", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"), F.split("text", CANDIDATE, -1).alias("gaps"))
    each = cut_up.select("doc_id", "path", "gaps", F.posexplode("found").alias("n", "candidate"))
    value = F.regexp_extract("candidate", _VALUE, 1)
    gap = lambda k: F.coalesce(F.get("gaps", k), F.lit(""))
    return each.select(
        "doc_id", "n", "candidate", F.when(value != "", value).otherwise(F.col("candidate")).alias("value"),
        F.right(gap(F.col("n")), F.lit(CONTEXT)).alias("left"), F.left(gap(F.col("n") + 1), F.lit(CONTEXT)).alias("right"), "path",
    )


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.greatest(F.length("value"), F.lit(1))


def value_features(values: DataFrame, words: Language) -> DataFrame:
    """value, f_pairs, f_covered of each distinct value."""
    distinct = values.select("value").distinct()
    runs = distinct.select("value", F.explode(F.regexp_extract_all("value", F.lit("[A-Z]?[a-z]{2,19}|[A-Z]{3,20}"), F.lit(0))).alias("run"))
    known = runs.join(words.dictionary, F.lower("run") == F.col("word")).groupBy("value").agg(F.sum(F.length("run")).alias("known"))
    letters = F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{2,}"), F.lit(0))
    pairs = F.flatten(F.transform(letters, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda k: F.substring(w, k, F.lit(2)))))
    seen = distinct.select("value", F.explode(pairs).alias("pair")).groupBy("value", "pair").agg(F.count(F.lit(1)).alias("n"))
    likely = seen.join(words.transitions, "pair", "left").groupBy("value").agg((F.sum(F.col("n") * F.coalesce("logp", F.lit(-8.0))) / F.sum("n")).alias("f_pairs"))
    both = distinct.join(known, "value", "left").join(likely, "value", "left")
    return both.select("value", F.coalesce("f_pairs", F.lit(-9.0)).alias("f_pairs"), (F.coalesce("known", F.lit(0)) / F.greatest(F.length("value"), F.lit(1))).alias("f_covered"))


def with_features(found: DataFrame, words: Language) -> DataFrame:
    length = F.greatest(F.length("value"), F.lit(1))
    changes = sum((F.regexp_count("value", F.lit(f"(?<=[{a}])(?=[{b}])")) for a, b in (("a-z", "0-9"), ("0-9", "a-z"), ("A-Z", "0-9"), ("0-9", "A-Z"), ("A-Z", "a-z"), ("a-z", "A-Z"))), F.lit(0))
    number = lambda c: c.cast("double")
    said = lambda side: F.filter(F.split(F.lower(side), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    left, right, path = F.reverse(said("left")), said("right"), said("path")
    marked = lambda mark, words_: F.transform(words_, lambda w: F.concat(F.lit(mark), w))
    nearby = F.concat(marked("l:", F.slice(left, 1, NEIGHBOURS)), marked("r:", F.slice(right, 1, NEIGHBOURS)), marked("p:", path))
    return found.join(value_features(found, words), "value").withColumns(
        {
            "f_length": number(F.length("value")),
            "f_changes": changes / length,
            "f_digits": _share("[0-9]"),
            "f_upper": _share("[A-Z]"),
            "f_lower": _share("[a-z]"),
            "f_symbols": _share("[^A-Za-z0-9]"),
            "f_hex": number(F.col("value").rlike("^(?i:[0-9a-f]+)$")),
            "f_distinct": F.size(F.array_distinct(F.split("value", ""))) / length,
            "f_named": number(F.col("candidate").rlike(_VALUE)),
            "f_assigned": number(F.col("left").rlike("[=:]\\s*[\"']?$") | F.col("candidate").rlike(_VALUE)),
            "f_quoted": number(F.col("right").rlike("^[\"']")),
            "f_placeholder": number(F.col("value").rlike(PLACEHOLDER)),
            "f_plain_number": number(F.col("value").rlike("^[0-9.\\-]+$")),
            "nearby": nearby,
        }
    )


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.greatest(F.length("value"), F.lit(1))


def labelled_findings(spark: SparkSession, rows: int = RULE_ROWS, start: int = 0, common: list[str] | None = None) -> DataFrame:
    """candidate, value, left, right, path, label drawn by hashes of row numbers; another ``start`` is another draw.

    Shapes belong to a class; names, words around and paths do with odds of about four to one only.
    """
    i = F.col("id")
    known = common or WORDS
    hashed = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), i), F.lit(n)).cast("int")
    pick = lambda salt, *options: F.element_at(F.array(*[F.lit(o) if isinstance(o, str) else o for o in options]), hashed(salt, len(options)) + 1)
    yes = hashed("label", 2) == 1
    lean = lambda salt, for_yes, for_no: F.when(yes == (hashed(f"{salt} odds", 5) > 0), pick(salt, *for_yes)).otherwise(pick(salt, *for_no))
    hexes = F.sha2(F.concat(F.lit("h"), i.cast("string")), 256)
    base = F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat(F.lit("b"), i.cast("string")), 512))), "[^A-Za-z0-9]", "")
    digits = F.regexp_replace(F.conv(F.substring(hexes, 1, 15), 16, 10), "[^0-9]", "")
    word = lambda salt: pick(salt, *known)
    secret = pick(
        "shape", F.substring(hexes, 1, 40), F.substring(hexes, 1, 32), hexes, F.substring(base, 1, 40), F.substring(base, 1, 24), F.concat(F.lit("AKIA"), F.upper(F.substring(base, 1, 16))),
        F.concat(F.lit("ghp_"), F.substring(base, 1, 36)), F.concat(F.lit("sk-"), F.substring(base, 3, 48)), F.concat(F.initcap(word("s1")), F.substring(base, 5, 6), F.lit("!"), F.substring(digits, 1, 4)),
    )
    other = F.concat(word("w1"), pick("sep", "_", "-", ""), F.initcap(word("w2")), pick("sep2", "_", "-", ""), word("w3"), hashed("number", 997).cast("string"))
    uuid = F.concat(F.substring(hexes, 1, 8), F.lit("-"), F.substring(hexes, 9, 4), F.lit("-"), F.substring(hexes, 13, 4), F.lit("-"), F.substring(hexes, 17, 12))
    decoy = pick("decoy", F.substring(hexes, 1, 40), hexes, F.rpad(digits, 16, "4"), F.rpad(digits, 18, "7"), other, other, other, uuid, F.lit("2024-01-15T10-30-00"), F.lit("changeme"), F.lit("your_token_here"), F.lit("xxxxxxxxxxxxxxxx"), F.lit("${ACCESS_TOKEN}"))
    value = F.when(yes, secret).otherwise(decoy)
    number = value.rlike("^[0-9]+$")
    named = ~number & (yes == (hashed("named", 5) > 0))
    at = F.concat(pick("name", "token", "password", "secret", "api_key", "apikey", "access-key", "auth", "TOKEN"), pick("eq", " = ", ": ", "="), pick("quote", '"', "'", ""))
    prose = [F.concat(word(f"p{k}"), F.lit(" "), word(f"q{k}"), F.lit(" ")) for k in range(4)]
    loose = ["bearer ", "private key ", "credential: ", "api key is ", *prose]
    safe = ["commit ", "sha256: ", "md5 checksum ", "uuid ", "order id ", "card ", "revision ", *prose]
    path = lean("path", ["src/app/settings.py", "deploy/prod.env", "config/main.yml", "notes.txt", ""], ["tests/data/fixture.json", "package.lock", "docs/guide.md", "notes.txt", ""])
    return spark.range(start, start + rows).select(
        F.when(named, F.concat(at, value)).otherwise(value).alias("candidate"),
        value.alias("value"),
        F.when(named, pick("before", *prose)).otherwise(lean("left", loose, safe)).alias("left"),
        F.concat(F.when(named, pick("quote", '"', "'", "")).otherwise(""), F.lit(" "), pick("after", *prose)).alias("right"),
        path.alias("path"),
        yes.cast("int").alias("label"),
    )


def train(findings: DataFrame, words: Language, seed: int = 7) -> PipelineModel:
    """A forest from labelled findings; at most MOST_ROWS of them, chosen by hash."""
    rows = findings.where("label is not null").orderBy(F.xxhash64("candidate", "left", "path")).limit(MOST_ROWS)
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=seed)
    stages = [HashingTF(inputCol="nearby", outputCol="hashed", numFeatures=HASHED, binary=True), VectorAssembler(inputCols=[*FEATURES, "hashed"], outputCol="features"), forest]
    # written once, as the forest reads its rows several times
    return Pipeline(stages=stages).fit(cut(with_features(rows, words).select("label", "nearby", *FEATURES), "training").coalesce(4))


def scan(docs: DataFrame, model: PipelineModel, words: Language, path: str | None = None) -> DataFrame:
    """doc_id, n, value, left, right, probability, secret of every candidate."""
    found = cut(candidates(docs, path), "candidates")
    scored = model.transform(with_features(found, words))
    chance = F.when(F.col("value").rlike(_KEY_BLOCK), F.lit(1.0)).otherwise(F.element_at(vector_to_array("probability"), 2))
    return scored.select("doc_id", "n", "value", "left", "right", chance.alias("probability"), (chance >= 0.5).alias("secret"))
