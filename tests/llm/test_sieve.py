"""The filter of a table's keys, and joins over it where nothing is few enough to be sent out."""

import numpy as np
import pytest
from millrace.llm import repeats, verify
from millrace.llm.sieve import Sieve
from pyspark.sql import functions as F
from tests.llm.test_operators import docs_of, prose


@pytest.mark.parametrize("rows", [0, 1, 30_000])
def test_holds_all_keys_and_few_others(spark, rows):
    keys = spark.range(rows).select(F.xxhash64("id").alias("key"))
    other = spark.range(10**6, 10**6 + 30_000).select(F.xxhash64("id").alias("key"))
    sieve = Sieve(keys, "key", rows)
    assert keys.where(~sieve.holds("key")).count() == 0
    assert other.where(sieve.holds("key")).count() <= 300
    assert other.select("key", F.when(sieve.holds("key"), 1).alias("x")).where("x is null").count() >= 29_700
    assert sieve.sent.value.holds(np.array([r["key"] for r in keys.limit(50).collect()], np.int64)).all()


def shuffled(spark):
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    return context.statusStore().executorList(True).apply(0).totalShuffleWrite()


def test_repeats_shuffle_what_has_a_partner(spark, monkeypatch):
    """Beyond the rows that may be sent out, texts and paragraphs without a partner are not shuffled for the joins."""
    rows = [(k, prose(("own", k), 600)) for k in range(400)]
    rows += [(1000 + 2 * k + c, f"{prose(('a', k, c), 60)} {prose(('p', k), 80)} {prose(('b', k, c), 60)}") for k in range(10) for c in range(2)]
    docs = docs_of(spark, rows).cache()
    docs.count()
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for limit in limits:  # these tables are small enough for Spark itself to send them out
        spark.conf.set(limit, "-1")
    began = shuffled(spark)
    sent_out = sorted(map(tuple, repeats.repeats(docs).collect()))
    middle = shuffled(spark)
    monkeypatch.setattr(verify, "SENT_OUT", 0)
    monkeypatch.setattr(repeats, "SENT_OUT", 0)
    found = sorted(map(tuple, repeats.repeats(docs).collect()))
    end = shuffled(spark)
    docs.unpersist()
    for limit in limits:
        spark.conf.unset(limit)
    assert found == sent_out and len({r[0] for r in found if r[1] == "passage"}) == 10
    assert end - middle <= 1.5 * (middle - began)
