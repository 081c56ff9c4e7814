"""Character weights a document at a time against the plain plan."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quarrystone.operators import chargrams, tfidf


@pytest.mark.parametrize("repeated", [False, True])
def test_character_weights_equal_the_plain_plan(spark, repeated):
    rng = random.Random(5)
    words = ["pump", "Pumps", "a", "東京", "𝒳y", "don't", "x", "Ähre", "pumpe"]
    texts = [(str(i // 2 if repeated else i), rng.choice([" \t".join(rng.choices(words, k=rng.randrange(1, 12))), "a " * 5000, "", None]), rng.choice(["train", "train", "test"])) for i in range(60)]
    texts = [(i, t, texts[int(i)][2]) for i, t, _ in texts]
    docs = spark.createDataFrame(texts, "report_id string, text string, split string")
    sample = tfidf.training_sample(docs)
    vocab = tfidf.vocabulary(tfidf.term_counts(sample, tfidf.char_terms(F.col("text"))), sample.count(), 60)
    mine = chargrams.vocabulary(docs, features=60)
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, vocab.collect())) and vocab.count() > 20
    want = {(r.report_id, r.term): r.weight for r in tfidf.weights(tfidf.term_counts(docs, tfidf.char_terms(F.col("text"))), vocab).collect()}
    made = chargrams.weights(docs, mine)
    got = {(r.report_id, r.term): r.weight for r in made.collect()}
    assert got == pytest.approx(want) and want
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert repeated or "Exchange" not in plan
