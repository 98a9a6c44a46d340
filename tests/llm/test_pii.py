"""Surrogates on texts made to break the patterns, on full spaces of addresses, and beside any column names."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from turnero.llm import pii


def test_long_texts_of_every_alphabet_end_no_executor(spark):
    """Texts of 40 to 100 kB that keep each repeated part of the patterns busy; all come back, those without entities as they were."""
    n = 20_000
    texts = ["x@" + "a." * n, "x@" + "ab." * 5000 + "com", "x@" + "a" * n + ".com", "a." * n + "@b.com", "Mr " + "Ab-" * n, "Mr Ab" + " Cd" * n,
             "0" * n, "+1 " + "12 " * n, "1." * n, "GB12 " + "ABCD " * n, "f" * n, "= '" + "A" * n, "1234-" * n, "Ünï" * n, "漢" * n, "x" * n + "@", "(" * n]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r for r in pii.replace(rows).select("doc_id", "n_entities", F.length("text").alias("n"), F.xxhash64("text").alias("h")).collect()}
    same = {r.doc_id: r.h for r in rows.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    assert len(got) == len(texts)
    assert all((got[i].n_entities == 0) == (got[i].h == same[i]) for i in same)


def test_every_address_of_a_full_space_gets_its_own(spark):
    """All 676 addresses of the form x@y.co: none is left that is not taken, so some grow; none collides or is real."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    real = [f"{x}@{y}.co" for x in letters for y in letters]
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(real)], "doc_id bigint, text string")
    new = [r.text for r in pii.replace(rows).collect()]
    assert len(set(new)) == 676 and not set(new) & set(real)
    assert all(re.fullmatch(r"[a-z]+@[a-z]\\.[a-z]{2}".replace("\\\\", "\\"), a) for a in new)


def test_a_space_without_room_is_an_error(spark):
    found = spark.createDataFrame([("ip", "1.2.3.4"), ("ip", "5.6.7.8")], "kind string, canon string")
    assert pii.distinct_surrogates(found).count() == 0
    with pytest.raises(ValueError, match="no surrogate"):
        pii.distinct_surrogates(spark.createDataFrame([("email", f"{x}@{y}.co") for x in "abcdefghijklmnopqrstuvwxyz" for y in "abcdefghijklmnopqrstuvwxyz"],
                                                      "kind string, canon string"), rounds=2)


def test_any_column_name_is_kept(spark):
    names = ("text_hash", "redrawn", "_hash", "_found", "_may", "_drawn", "_new", "__x", "kind", "canon", "x", "e", "stream", "entities")
    rows = spark.createDataFrame([(1, "Mail me: jo@example.com"), (2, None)], "doc_id bigint, text string").withColumns(
        {c: F.lit(f"own {c}") for c in names})
    got = pii.replace(rows)
    assert got.columns == [*rows.columns, "n_entities", "entity_kinds"]
    again = pii.replace(got)
    assert again.columns == got.columns
    for r in got.collect():
        assert all(r[c] == f"own {c}" for c in names) and (r.n_entities, r.text is None) in {(1, False), (0, True)}
