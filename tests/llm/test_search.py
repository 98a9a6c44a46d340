"""Decontamination, ranked lexical search and hard negatives against brute force and SQL, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.compare import connect
from turnero.llm import decontaminate, lexical, negatives, oracle, queries, words
from turnero.llm.common import table
from turnero.llm.fm_index import Index, suffix_order

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CLASHES = ("key", "row", "id", "item", "n", "docs", "spans", "term", "score", "t", "label2", "_row")


def plain_words(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(oracle.STATEMENTS))
def test_equals_its_sql(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    cursor = connect(SF).execute(oracle.STATEMENTS[name])
    assert rows(frame.select(*(d[0] for d in cursor.description))) == sorted(map(tuple, cursor.fetchall()), key=repr)


def test_words(monkeypatch):
    random.seed(2)
    letters = "abAbZz09 \n\té漢🙂-_@[`{~\x7f\x80İ"
    texts = [None, "", *("".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(1000))]
    for size in (7, 64, 1 << 21):
        monkeypatch.setattr(words, "WINDOW", size)
        found = [[] for _ in texts]
        for some in words.Cutter().windows(pa.array(texts, pa.string())):
            for i, a, b in some.parts:
                found[i] += [some.distinct[k].decode() for k in some.inverse[a:b]]
        assert found == [plain_words(t) for t in texts]


def test_colliding_words_take_another_hash(monkeypatch):
    """Under the multiplier 1 a word's hash is the sum of its bytes, so anagrams collide."""
    monkeypatch.setattr(words, "MULTIPLIERS", (1, *words.MULTIPLIERS))
    some = next(words.Cutter().windows(pa.array(["ab ba abc cab"])))
    assert [some.distinct[k] for k in some.inverse] == [b"ab", b"ba", b"abc", b"cab"]
    monkeypatch.setattr(words, "MULTIPLIERS", (1,))
    with pytest.raises(ValueError):
        next(words.Cutter().windows(pa.array(["ab ba"])))


def test_index_counts_and_locates():
    random.seed(1)
    for trial in range(40):
        top = random.choice([1, 2, 3, 30])
        docs = [[random.randint(1, top) for _ in range(random.randint(0, random.choice([1, 5, 100])))] for _ in range(random.randint(1, 6))]
        docs += [docs[0]] * (2 * (trial % 3 == 0))
        text = np.array([x for d in docs for x in [*d, 0]])
        offsets = np.concatenate(([0], np.cumsum([len(d) + 1 for d in docs])))
        held = Index.build(text, offsets, pa.array([b"w%d" % k for k in range(1, top + 1)], pa.binary()))
        made = held.dump()
        index = Index.load(**made)
        for m in (1, 2, 3, 5):
            asked = np.array([[random.randint(0, top) for _ in range(m)] for _ in range(20)])
            for phrase, low, high in zip(asked, *index.count(asked)):
                want = [i for i in range(len(text) - m + 1) if list(text[i:i + m]) == list(phrase) and 0 not in phrase]
                assert sorted(index.locate(np.arange(low, high)).tolist()) == want
    line = np.append(np.random.default_rng(0).integers(1, 3, 300), 0)
    assert suffix_order(line, 3).tolist() == sorted(range(301), key=lambda i: line[i:].tolist())


def brute_contaminated(docs, items, window=10):
    held = {}
    for item, text in items:
        line = plain_words(text)
        m = min(window, len(line))
        for a in range(len(line) - m + 1) if line else ():
            held.setdefault(tuple(line[a:a + m]), set()).add(item)
    out = []
    for doc, text in docs:
        line, hit, found = plain_words(text), set(), set()
        for m in {len(k) for k in held}:
            for a in range(len(line) - m + 1):
                if (own := held.get(tuple(line[a:a + m]))) is not None:
                    hit |= set(range(a, a + m))
                    found |= {str(x) for x in own if x is not None}
        out.append((doc, len(line), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    """Documents and items with nulls, empty texts, repeats, a long text, short items and clashing columns."""
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").limit(120).collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    docs += [(None, docs[3][1]), (None, None), (7, ""), (7, "a b c"), (7, "a b c"), (900, " ".join(t for _, t in docs[:40]) + items[0][1])]
    docs += [(1000 + k, docs[5][1]) for k in range(60)]
    items += [(None, "a b"), (100, "b c"), (100, "c"), (101, None), (102, "  "), (103, items[1][1]), (104, "zzzzz qqqqq")]
    extra = {c: F.lit("x") for c in CLASHES}
    return (docs, items, spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4).withColumns(extra),
            spark.createDataFrame(items, "item_id bigint, text string").withColumns(extra))


def test_contaminated_against_brute_force(odd, monkeypatch):
    docs, items, d, b = odd
    want = brute_contaminated(docs, items)
    assert sum(r[5] for r in want) > 3
    assert rows(decontaminate.contaminated(d, b).drop("spans")) == want
    # Many shards, many blocks of phrases, texts and items in several pieces.
    monkeypatch.setattr(decontaminate, "SHARD", 200)
    monkeypatch.setattr(decontaminate, "BLOCK", 100)
    monkeypatch.setattr(decontaminate, "PIECE", 30)
    found = decontaminate.contaminated(d, b)
    assert rows(found.drop("spans")) == want
    for r in found.where("contaminated").collect():
        assert sum(s.b - s.a for s in r.spans) == r.n_hit and all(x.b < y.a for x, y in zip(r.spans, r.spans[1:]))
    assert rows(decontaminate.contaminated(d, b.limit(0)).select("n_hit").distinct()) == [(0,)]
    assert decontaminate.contaminated(d.limit(0), b).count() == 0


def test_decontaminated_texts_hold_no_window(odd):
    docs, items, d, b = odd
    after = decontaminate.decontaminated(d, b)
    assert after.columns == d.columns and after.count() == len(docs)
    left = sorted((r.doc_id or -1, r.text or "") for r in after.collect())
    hit = {r[0] for r in brute_contaminated(docs, items) if r[5]}
    clean = sorted((i or -1, t or "") for i, t in docs if i not in hit)
    assert [x for x in left if x[0] not in {i or -1 for i in hit}] == clean
    for doc, n, n_hit, *_ in brute_contaminated(docs, items):
        if n_hit and doc and doc > 1000:
            assert len(plain_words(dict(left)[doc])) == n - n_hit


def brute_search(docs, items, k):
    held = [(d, Counter(plain_words(t))) for d, t in docs]
    n_docs, n_terms = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in Counter(t for _, c in held for t in c).items()}
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(plain_words(text))
    out = []
    for item, terms in asked.items():
        found = []
        for doc, c in held:
            if c:
                m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
                score = sum(weight[t] * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
                if score > 0:
                    found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_lexical_against_brute_force(odd, monkeypatch, small):
    docs, items, d, b = odd
    if small:  # many buckets, blocks of queries and windows
        monkeypatch.setattr(lexical, "BUCKET", 16)
        monkeypatch.setattr(lexical, "POSTINGS", 500)
        monkeypatch.setattr(lexical, "BLOCK", 200)
        monkeypatch.setattr(words, "WINDOW", 3000)
    assert rows(lexical.search(d, b, 7)) == brute_search(docs, items, 7)
    if small:
        assert lexical.search(d.limit(0), b).count() == 0 and lexical.search(d, b.limit(0)).count() == 0


def test_lexical_bounds_prune():
    """Buckets below the bound are not scored; those above are scored whole."""
    weights = np.array([9, 4], np.int64)
    bucket = {"longest": 5.0, "lengths": np.array([5.0, 1.0]), "codes": np.array([0, 1]), "starts": np.array([0, 1, 2]), "docs": np.array([0, 1]),
              "impacts": np.array([1, 1]), "ids": np.array([1, 2]), "null": np.zeros(2, bool)}
    best = [lexical._Best(2, 1), lexical._Best(2, 10 ** 6)]
    lexical._look(bucket, weights, [np.array([0, 1]), np.array([0, 1])], best)
    assert best[0].id.tolist() == [1, 2] and best[0].score.tolist() == [9, 4] and not len(best[1].id)


def brute_mine(held, positives=5, negatives=3, least=50, most=95):
    """``held``: (id, label, components)."""
    out = []
    for a, label, v in held:
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in held if i != a)
        for p in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and least * -p[0] <= 100 * -s[0] <= most * -p[0]][:negatives]
            out += [(a, p[1], r + 1, s[1], -p[0], -s[0]) for r, s in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_negatives_against_brute_force(spark, monkeypatch, small):
    rng = np.random.default_rng(3)
    raw = []
    for i in range(600):
        v = rng.standard_normal(24) + 1.5 * (i % 5 == np.arange(24))
        raw.append((i, int(i % 5), [float(x) for x in v.astype(np.float32)]))
    raw += [(1000 + i, 1, raw[50][2]) for i in range(40)] + [(2000, 2, raw[7][2][:5]), (2050, 3, [0.0] * 24), (2100, 4, [])]
    lost = [(3000, None, raw[0][2]), (3050, 1, None), (3100, 1, [float("nan")] * 24), (3150, 1, [None] * 24), (3200, 1, [float("inf")] * 24), (None, 1, raw[0][2])]
    frame = spark.createDataFrame(raw + lost + raw[:30], "vec_id bigint, label int, embedding array<float>").withColumns(
        {c: F.lit("x") for c in ("id", "v", "r", "anchor", "score", "n", "labels")})
    if small:
        monkeypatch.setattr(negatives, "CHUNK", 50)
        monkeypatch.setattr(negatives, "BLOCK", 100)
    held = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in raw]
    got = rows(negatives.mine(negatives.prepared(frame), F.col("id") % 50 == 0))
    assert sorted(got) == brute_mine(held) and len(got) > 50
    assert negatives.mine(negatives.prepared(frame.limit(0)), F.col("id") % 50 == 0).count() == 0


def test_intervals_hold_the_scores():
    rng = np.random.default_rng(1)
    for dims, scale in ((64, 30), (7, 300), (130, 5), (1, 9), (64, 0)):
        x = (rng.standard_normal((300, dims)) * scale).astype(np.int64)
        turns = negatives.rotations(dims)
        codes, alignments, rests = negatives.code(x, turns)
        cells = {"ids": np.arange(300), "labels": np.zeros(300, np.int64), "vectors": x, "codes": codes, "alignments": alignments, "rests": rests}
        chunk = negatives.Chunk({"dims": dims} | {c: v.tobytes() for c, v in cells.items()})
        for q in x[:10]:
            widths = []

            def choose(low, high):
                assert (low <= x @ q).all() and (x @ q <= high).all()
                widths.append((high - low).mean())
                return np.ones(len(low), bool)

            chunk.survivors(negatives.Anchor(0, 0, q, turns), np.arange(300), choose)
            assert dims < 64 or scale == 0 or widths[-1] < 0.3 * widths[0]
