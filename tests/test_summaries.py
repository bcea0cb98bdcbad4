"""Summaries: the same as by words and joins, without moving texts that are alone under their key."""

import random

from ledgerloom.operators import documents as D

SCHEMA = "doc_id bigint, text string"


def test_summaries_of_lone_and_shared_keys_are_those_by_joins(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "of", "ÄÖÜß", "a b", "x yz", "\U0001f600\U0001f600\U0001f600"])
    gap = lambda: rng.choice([" ", "  ", "\t", "\n", "\x0b", " ", ". ", "?!", "..."])
    texts = ["".join(word() + gap() for _ in range(rng.randrange(30))) for _ in range(60)] + [None, "", " .!? ", "a", ". b"]
    docs = spark.createDataFrame([(i if i % 7 else i // 14, t) for i, t in enumerate(texts)] + [(None, "some words"), (None, None)], SCHEMA)
    for words in (1, 20):
        got, old = (sorted(map(str, f(docs, words, "doc_id", "text", 5).collect())) for f in (D.text_summarize, D._summaries_by_key))
        assert got == old


def test_lone_texts_are_not_shuffled(spark):
    docs = spark.createDataFrame([(1, "one two three. four"), (2, None)], SCHEMA)
    found = D.text_summarize(docs, 20)
    assert {(r.doc_id, r.summary) for r in found.collect()} == {(1, "one two three"), (2, None)}
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Exchange hashpartitioning" not in plan
