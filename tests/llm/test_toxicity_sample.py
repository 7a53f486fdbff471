"""The toxicity classifier's sample and its log-count ratios."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.llm import toxicity

FREE = [k for k in range(1000) if zlib.crc32(str(k).encode()) % 5]


def corpus(spark, repeats):
    """200 documents, half of them toxic; ``repeats``: (place in the list, how many more rows of that id)."""
    said = ["you are a vile horrid pest number", "thank you for this kind and good note number"]
    rows = [(i, f"{said[k % 2]} {k} of {k % 7}") for k, i in enumerate(FREE[:200])]
    labels = [(i, 1 - k % 2) for k, i in enumerate(FREE[:200])]
    rows += [rows[at] for at, n in repeats for _ in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.mark.parametrize("per_class", [50, 8_000])
def test_repeated_ids_change_nothing(spark, per_class):
    plain, labels = corpus(spark, [])
    # every id of either class in turn has many more rows than the sample may have
    hashed = {r.doc_id: r.h for r in plain.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    first = {y: min((k for k in range(200) if 1 - k % 2 == y), key=lambda k: hashed[FREE[k]]) for y in (0, 1)}
    want = None
    for repeats in ([], [(first[1], 61)], [(first[0], 300)], [(first[0], 90), (first[1], 90), (7, 70)]):
        docs, _ = corpus(spark, repeats)
        rows = toxicity.training_rows(docs, labels, per_class=per_class)
        assert Counter(r.y for r in rows.collect()) == {0: min(100, per_class), 1: min(100, per_class)}
        model = toxicity.train(docs, labels, per_class=per_class)
        got = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
        want = want or got
        assert all(abs(got[i] - want[i]) < 1e-6 for i in want)
        assert all((got[i] >= 0.5) == (k % 2 == 0) for k, i in enumerate(FREE[:200]))


def test_an_id_with_several_texts_counts_once(spark):
    docs = spark.createDataFrame([(FREE[0], "b"), (FREE[0], "a"), (FREE[0], None), (FREE[1], "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(FREE[0], 1), (FREE[1], 0)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels).collect()
    assert len(rows) == 2 and {r.y for r in rows} == {0, 1}
    assert sorted(rows) == sorted(toxicity.training_rows(docs.repartition(3, "text"), labels).collect())


def test_log_count_ratios_equal_brute_force(spark):
    docs, labels = corpus(spark, [(3, 40)])
    rows = toxicity.training_rows(docs, labels)
    features, ratios = toxicity._log_ratios(rows, (100, 100))
    found = [(set(toxicity.present(r.text).tolist()), r.y) for r in rows.collect()]
    n = [sum(y == k for _, y in found) for k in (0, 1)]
    want = {}
    for feature in set().union(*(s for s, _ in found)):
        no, yes = (sum(feature in s for s, y in found if y == k) for k in (0, 1))
        ratio = math.log((yes + 1) / (n[1] + 2)) - math.log((no + 1) / (n[0] + 2))
        if abs(ratio) / math.sqrt(1 / (yes + 1) + 1 / (no + 1)) >= toxicity.SIGNIFICANT:
            want[feature] = ratio
    assert want and features.tolist() == sorted(want)
    assert np.allclose(ratios, [want[f] for f in sorted(want)])
