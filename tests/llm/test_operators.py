"""Corpus operators against brute force, and on nulls, empty and repeated rows, empty tables and extra columns."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps, PandasGroupedOpsMixin

from turnero.llm import ann, bpe, mixing, passages, pii, quality, sharding, simhash, toxicity, warc
from turnero.llm.common import table
from turnero.llm.components import connected_components

SF = "/root/testdata/sf0.001"
ODD = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "one two three four five six", "en", "s", 1),
       (3, "one two three four five six", "en", "s", 1), (4, "x" * 30_000, "en", "t", 2), (None, "word " * 20_000, "de", "s", 3),
       (5, "Ünïcode  \x1f\n\n\r\t 漢字 🙂", "fr", "(rest)", 4)]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = ("key", "c", "fp", "shard", "score", "_w", "hash", "n")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("x") for c in CLASHES})


def key_of(rows):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in rows.select("doc_id").collect())


def test_bpe_equals_the_library(spark, docs, odd):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for rows in (docs, odd):
        want = []
        for r in rows.collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            want.append((r.doc_id or -1, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        assert sorted((r[0] or -1, *r[1:]) for r in bpe.encode(rows, path).collect()) == sorted(want)
    encoder = bpe.Encoder(path)
    random.seed(1)
    letters = "abcdeİΣßﬁé ́\u0085 ​\x1c\x0b\x0c\n\t'sS tTreREd0१²#$…漢🙂 Ⅳ"
    for k in range(500):
        text = "".join(random.choice(letters) for _ in range(random.randint(0, 40))) + "<|endoftext|>" * (k % 7 == 0)
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.texts([text])[0] == (len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))
    assert bpe.encode(docs.limit(0), path).count() == 0


def test_simhash_components(spark, docs, odd):
    for rows in (docs, odd):
        held = [(r.doc_id, simhash.fingerprint(r.text, 3)) for r in rows.collect()]
        parent = list(range(len(held)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for i, (_, a) in enumerate(held):
            for j in range(i):
                if bin((a ^ held[j][1]) & (2 ** 64 - 1)).count("1") <= 2:
                    parent[root(i)] = root(j)
        least = {}
        for i, (d, _) in enumerate(held):
            if d is not None:
                least[root(i)] = min(least.get(root(i), d), d)
        want = sorted((d or -1, f"{fp & (2 ** 64 - 1):016x}", least.get(root(i)) or -1) for i, (d, fp) in enumerate(held))
        assert sorted((r[0] or -1, r[1], r[2] or -1) for r in simhash.components(rows).collect()) == want
    assert simhash.components(docs.limit(0)).count() == 0
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and key_of(kept).count((False, 3)) == 1


def test_fingerprint_bits_by_hand(spark):
    words = ["a", "b", "c", "d"]
    hashes = [r.h & (2 ** 64 - 1) for r in spark.createDataFrame([(" ".join(words[i:i + 3]),) for i in range(2)], "t string").select(F.xxhash64("t").alias("h")).collect()]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > 2)
    assert simhash.fingerprint("A b\tC  d", 3) & (2 ** 64 - 1) == want
    values = np.array([random.Random(5).getrandbits(62) for _ in range(130)], np.uint64)
    for radius in (1, 2, 3):
        got = [x for x in simhash.near(int(values[7]) ^ 5, simhash.planes(values), radius) if x < 130]
        assert got == [i for i, v in enumerate(values.tolist()) if bin(v ^ int(values[7]) ^ 5).count("1") <= radius]


def test_connected_components(spark):
    random.seed(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, k) for k in range(1, 40)] + [(500, 500), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "x bigint, y bigint"), "x", "y").collect()}
    assert got == {k: 0 for k in range(40)} | {k: 100 for k in range(100, 161)}


def test_sharding_is_the_smallest_greedy_partition(spark, docs, odd):
    for rows, shards in ((docs, 40), (odd, 3)):
        out = sharding.shard(rows, shards).collect()
        assert len(out) == rows.count() and {r.law for r in out} == {"bytes"} and max(r.shard for r in out) < shards
        texts = {}
        for r in rows.collect():
            key = hashlib.sha256((r.text or "").encode()).hexdigest()
            texts[key] = texts.get(key, 0) + len((r.text or "").encode()) + 16
        sizes = [texts[k] for k in sorted(texts)]

        def needed(capacity):
            used, at = 1, 0
            for s in sizes:
                if at + s > capacity:
                    used, at = used + 1, 0
                at += s
            return used
        capacity = max(sizes)
        while needed(capacity) > shards:
            capacity += 1
        loads = {}
        for r in out:
            loads.setdefault(r.shard, []).append(r)
        assert max(sum(r["size"] for r in part) for part in loads.values()) <= capacity
        for part in loads.values():
            assert sorted(r.slot for r in part) == list(range(len(part)))
    assert sharding.shard(docs.limit(0)).count() == 0


def test_mixing_stays_within_one_block(spark, docs, odd):
    rows = mixing.mix(docs.select("doc_id", "source"), block=2).collect()
    assert len(rows) == docs.count() and len({(r.mix_slot, r.mix_place) for r in rows}) == len(rows)
    for trial in range(30):
        rng = random.Random(trial)
        weights = mixing.parts_of({f"s{i}": rng.random() + 0.01 for i in range(rng.randint(1, 7))}, 50)
        blocks = {s: rng.randint(0, 40) for s in weights}
        at = {}
        for p in mixing.phases(weights, blocks):
            for s in p.first:
                for j in range(p.first[s], p.last[s]):
                    k = j - p.first[s]
                    at[p.start + k // weights[s] * p.period + p.slots[s][k % weights[s]]] = (s, p)
        assert sorted(at) == list(range(sum(blocks.values())))
        now = None
        for slot in range(len(at)):
            s, p = at[slot]
            if p is not now:
                now, got = p, dict.fromkeys(p.first, 0)
            got[s] += 1
            assert all(abs(got[x] - weights[x] * (slot + 1 - p.start) / p.period) < 1 for x in got)
    assert mixing.in_mixed_order(odd).count() == odd.count() and mixing.in_mixed_order(odd).columns == odd.columns
    assert mixing.mix(docs.limit(0)).count() == 0


def test_quality_counts_and_guarantee(spark, docs, labels, odd):
    def counts(text):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        places, covered = {}, set()
        for i in range(len(words) - 7):
            places.setdefault(tuple(words[i:i + 8]), []).append(i)
        for found in places.values():
            if len(found) > 1:
                for i in found:
                    covered.update(range(i, i + 8))
        n, rep = len(words), len(covered)
        return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), rep, n < 20 or 100 * rep > 30 * n
    for rows in (docs, odd):
        got = quality.judged(rows, labels).collect()
        assert sorted((r[0] or -1, *r[1:7]) for r in got) == sorted((r.doc_id or -1, *counts(r.text)) for r in rows.collect())
        assert not any(r.kept and r.base_failed for r in got)
    assert quality.judged(docs.limit(0), labels).count() == 0
    assert quality.judged(docs, labels.limit(0)).where("kept = base_failed").count() == 0
    from math import comb, log
    for r in spark.createDataFrame([(k, 300) for k in (0, 1, 3, 6)], "k long, n long").withColumn("t", quality.binomial_tail(F.col("k"), F.col("n"), 0.02)).collect():
        assert abs(r.t - log(sum(comb(300, i) * 0.02 ** i * 0.98 ** (300 - i) for i in range(r.k + 1)))) < 1e-9
    held = spark.createDataFrame([("x", i / 1000) for i in range(1000)], "stratum string, r_a double")
    cut = quality.cutoffs(held, 0.05, 0.05, {"a": [0.999, 0.99, 0.98, 0.96, 0.9]}).collect()
    assert [(r.rule, r.cutoff) for r in cut] == [("a", 0.98)]


def test_pii_surrogates(spark, odd):
    texts = ["Call +1 (017) 555-7713 or +10175557713. Mail und.34@mail7.example.com, UND.34@mail7.example.com",
             "a 4111 1111 1111 1111 and 4111111111111111 b 138.39.1.2. 078-05-1120", None, "", "3.14 and 1,000,000 on 2024-05-06",
             'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce" Mr. John Smith, Mrs Mary Smith, Mr JOHN SMITH']
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("kind", F.lit(1))
    got = [r for r in sorted(pii.replace(rows).collect())]
    assert [r.n_entities for r in got] == [4, 4, 0, 0, 0, 4] and got[2].text is None and got[4].text == texts[4]
    phones = re.findall(r"\+1 ?\(?(\d{3})\)? ?(\d{3})-?(\d{4})", got[0].text)
    mails = re.findall(r"\S+@\S+\.com", got[0].text)
    assert len(phones) == 2 and phones[0] == phones[1] and "017" not in phones[0] and mails[0].lower() == mails[1].lower()
    cards = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}", got[1].text)
    assert cards[0].replace(" ", "") == cards[1] != "4111111111111111"
    assert sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(cards[1]))) % 10 == 0
    assert not re.search(r"b44e15|John|Mary|138\.39|078-05", " ".join(r.text or "" for r in got))
    names = re.findall(r"Mrs?\.? (\w+ [\w-]+)", got[5].text)
    assert names[0].upper() == names[2] and names[0].split()[0] in pii.NAMES["latin"]["m"] and names[1].split()[0] in pii.NAMES["latin"]["f"]
    many = spark.createDataFrame([(i, f"Mr A{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i // 100]} Xu") for i in range(600)], "doc_id bigint, text string")
    assert pii.replace(many).select("text").distinct().count() == 600
    assert pii.replace(odd).columns == [*odd.columns, "n_entities", "entity_kinds"] and pii.replace(odd).count() == odd.count()
    assert pii.replace(rows.limit(0)).count() == 0


def test_ann_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype("float32").tolist()) for i in range(300)] + [(400 + i, [1.0] * 8) for i in range(60)]
    rows += [(900, None), (901, [0.0] * 8), (902, [float("nan")] + [1.0] * 7), (903, [None] + [1.0] * 7), (904, [1.0, 2.0]), (None, [1.0] * 8), (400, [1.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("v", F.lit(1))
    good = {i: np.array(v, float) for i, v in rows[:360]}
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert abs(r.score - good[r.query_id] @ good[r.vec_id]) < 1e-9
    for q in (i for i in good if i % 20 == 0):
        assert got[q] == sorted((i for i in good if i != q), key=lambda i: (-round(float(good[q] @ good[i]), 9), i))[:20]
    assert set(got) == {i for i in good if i % 20 == 0}
    assert ann.search(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_bpe_remembers_a_bounded_number_of_words():
    texts = [" ".join(f"w{i:06x}" for i in range(at, at + 1000)) for at in range(0, 300_000, 1000)]
    known, most = bpe.Encoder(public_tokenizers.path("word_bpe_49k.json")), 0
    rows = []
    for run in bpe.slices(texts):
        rows += known.texts(run)
        most = max(most, len(known.pieces), len(known.known))
    assert len(rows) == 300 and most < 230_000  # what is remembered, and the words of one run
    assert rows[-1:] == bpe.Encoder(public_tokenizers.path("word_bpe_49k.json")).texts(texts[-1:])


def test_ann_rows_follow_the_queries_not_the_lists(spark, monkeypatch):
    made, apply = [], PandasCogroupedOps.applyInPandas
    monkeypatch.setattr(PandasCogroupedOps, "applyInPandas", lambda *a, **k: made.append(apply(*a, **k)) or made[-1])
    monkeypatch.setattr(ann, "PER_LIST", 16)
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((2000, 16)).astype("float32")
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 20 == 0, probed=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    products = vectors.astype(float) @ vectors.astype(float).T
    for q in range(0, 2000, 20):
        assert got[q] == sorted((i for i in range(2000) if i != q), key=lambda i: -products[q, i])[:20]
    assert len(got) == 100 and sum(m.count() for m in made) < 100 * 300  # 21 of each of 125 lists would be 160000 at most


@pytest.mark.parametrize("dims, n, alive", [(64, 2000, 0.1), (64, 2000, 0.0), (64, 2000, 1.1), (40, 500, 1.1), (16, 500, 0.1), (5, 100, 0.1), (64, 30, 0.1)])
def test_ann_scans_a_list_for_many_queries_at_once(monkeypatch, dims, n, alive):
    monkeypatch.setattr(ann, "ALIVE", alive, raising=False)  # 0.0: never pair by pair, 1.1: from the first block on
    rng = np.random.default_rng(3)
    x, q, turn = rng.standard_normal((n, dims)), rng.standard_normal((70, dims)), ann.rotation(dims)
    x[:n // 3] *= 0.3
    blocks = [np.ascontiguousarray((x @ turn)[:, a:a + ann.BLOCK]) for a in range(0, dims, ann.BLOCK)]
    partial, keep, products = list(np.cumsum([(b ** 2).sum(axis=1) for b in blocks], axis=0)), 21, q @ x.T
    best = -np.sort(-products, axis=1)
    for floor in (np.full(70, -np.inf), best[:, 10].copy()):
        row, place = ann.scan(q @ turn, blocks, partial, keep, floor)
        scores = products[row, place]
        stay = scores >= ann.edges_of(row, scores, keep, floor)[row]
        got = sorted(zip(row[stay].tolist(), place[stay].tolist()))
        want = [(i, j) for i in range(70) for j in range(n) if products[i, j] >= max(best[i, min(n, keep) - 1], floor[i])]
        assert len(set(got)) == len(got) and set(got) <= set(want) and len(got) >= 0.99 * len(want)


def test_warc_round_trip(spark):
    rows = [(1, "http://a.b.com/x\ny", None), (2, None, ""), (3, "https://user@A.b.com:80/Q?x#y", "p\r\n\r\nq é🙂"),
            (4, "http://a.b.com/x", "p\r\n\r\nq é🙂"), (4, "http://a.b.com/x", "p\r\n\r\nq é🙂"), (9, "u", "z" * 5_000_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("archive", F.lit("x"))
    first = {}
    for p, _, h in rows:
        first[h or ""] = min(first.get(h or "", p), p)
    want = sorted((p, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(),
                   "response" if first[h or ""] == p else "revisit", None if first[h or ""] == p else first[h or ""]) for p, _, h in rows)
    assert sorted(tuple(r) for r in warc.captures(pages).collect()) == want
    assert warc.captures(pages.limit(0)).count() == 0
    assert table(spark, SF, "pages").count() == warc.captures(table(spark, SF, "pages")).count()


def test_warc_archives_lie_and_move_compressed(spark):
    rows = [(i, f"http://h.org/{i}", f"page {i} " + "some words of a page " * 500) for i in range(40)]
    archives = warc.write(spark.createDataFrame(rows, "page_id bigint, url string, html string"), archive_bytes=100_000)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(archives.folder).select("content").collect()
    texts = [gzip.decompress(bytes(f.content)).decode() for f in files]  # whole gzip files
    assert sum(len(f.content) for f in files) < sum(map(len, texts)) / 4 and sum(t.count("WARC/1.1\r\n") for t in texts) == 40
    keys = [(warc.line_key(f"org,h)/{k}", k, hashlib.md5(f"{k}|http://h.org/{k}|{base64.b32encode(hashlib.sha1(rows[k][2].encode()).digest()).decode()}".encode()).hexdigest()),)
            for k in (3, 17)]
    got = warc.read(warc.locate(spark.createDataFrame(keys, "key string"), archives), archives, payload=True).collect()
    assert sorted((r.page_id, r.html) for r in got) == [(k, rows[k][2]) for k in (3, 17)]


def test_repeated_passages(spark, odd):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    line = lambda n: " ".join(word() for _ in range(n))
    shared, para = line(60), line(40)
    near = para.split()
    near[-1] = "changed"
    rows = [(1, line(50) + " " + shared + " " + line(50)), (2, line(30) + " " + shared + " " + line(9)), (3, line(200)),
            (4, line(10) + "\n" + para), (5, " ".join(near) + "\n" + line(12)), (6, None), (7, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("place", F.lit(1))
    got = passages.repeats(frame).collect()
    assert {r.doc_id for r in got} == {1, 2, 4, 5}
    assert {(r.doc_id, r.kind, r.class_id, r.removed) for r in got} == {
        (1, "passage", 1, False), (2, "passage", 1, True), (4, "paragraph", 4, False), (5, "paragraph", 4, True)} | {
        (d, "passage", 4, d == 5) for d in (4, 5) if any(r.kind == "passage" and r.doc_id == d for r in got)}
    cleaned = {r.doc_id: r.text for r in passages.without_repeats(frame.drop("place")).collect()}
    assert cleaned[3] == rows[2][1] and near[3] not in cleaned[5] and para in cleaned[4]
    assert passages.repeats(odd).where("doc_id is null").count() == 0 and passages.repeats(frame.limit(0)).count() == 0
    bands, per = passages.tuned()
    assert 1 - (1 - 0.8 ** per) ** bands >= 0.999


def test_paragraphs_of_small_buckets_meet_without_python_groups(spark, monkeypatch):
    made, apply = [], PandasGroupedOpsMixin.applyInPandas
    monkeypatch.setattr(PandasGroupedOpsMixin, "applyInPandas", lambda *a, **k: made.append(apply(*a, **k)) or made[-1])
    rng = random.Random(5)
    found, bucket = {}, {}
    for pid in range(90):  # a bucket's smallest member is like none, the others are in families of alike ones
        if pid % 30 < 3:
            family = [rng.getrandbits(63) for _ in range(rng.randint(30, 900))]
        bucket[pid] = pid // 30
        family = family if pid % 7 else [rng.getrandbits(63) for _ in range(60)]
        found[pid] = sorted({x if rng.random() > 0.05 else rng.getrandbits(63) for x in family})
    sets = spark.createDataFrame([(p, [x - (1 << 62) for x in v]) for p, v in found.items()], "pid bigint, found array<bigint>")
    members = spark.createDataFrame([(bucket[p], p, p) for p in found], "key int, pid bigint, component bigint")

    def classes(links):
        of = {p: p for p in found}
        for a, b in sorted(links):
            of = {p: of[a] if c == of[b] else c for p, c in of.items()}
        return sorted(sorted(p for p in of if of[p] == c) for c in set(of.values()))

    alike = lambda a, b: len(set(found[a]) & set(found[b])) >= 0.8 * len(set(found[a]) | set(found[b]))
    want = classes([(a, b) for a in found for b in found if a < b and bucket[a] == bucket[b] and a % 30 and alike(a, b)])
    assert 10 < len(want) < 80
    for small, grouped in ((64, False), (4, True)):
        monkeypatch.setattr(passages, "SMALL", small, raising=False)
        monkeypatch.setattr(passages, "CHUNK", 8)
        made.clear()
        assert classes([tuple(r) for r in passages._check_buckets(members, sets, 0.8).collect()]) == want
        assert (sum(m.count() for m in made) > 0) == grouped


def test_toxicity_held_out_and_grammar(spark, docs, labels, odd):
    got = toxicity.scored(odd, labels)
    assert got.count() == odd.count() and got.where("score not between 0 and 1 or predicted <> cast(score >= 0.7 as int)").count() == 0
    assert toxicity.keep_clean(odd, labels).columns == odd.columns
    assert toxicity.scored(docs.limit(0), labels).count() == 0 and toxicity.scored(docs, labels.limit(0)).count() == docs.count()
    weight = toxicity.clause_weight
    insult, target, no, said, threat = toxicity.INSULT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT, toxicity.THREAT
    assert weight([insult], [2]) < weight([target, insult], [0, 2])
    assert weight([no, insult], [0, 2]) < weight([insult], [2]) and weight([said, insult], [0, 2]) < weight([insult], [2])
    assert weight([threat], [2]) < weight([threat, target], [2, 0])


def test_toxicity_finds_held_out_toxic_documents(spark):
    folder = "/root/testdata/sf0.1"
    rows = toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels")).where("held_out").join(table(spark, folder, "labels"), "doc_id")
    cells = {(r.toxic, r.predicted): r["count"] for r in rows.groupBy("toxic", "predicted").count().collect()}
    assert cells[1, 1] > 0.85 * (cells[1, 1] + cells[1, 0]) and cells.get((0, 1), 0) < 0.02 * cells[0, 0]


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, SF)
        assert made.columns == docs.columns
    assert corpus_pipeline.run(spark, SF).count() <= docs.count()


def test_pii_gate_lets_every_match_through(spark, docs):
    texts = ["mail a@b.co", "Mr. John Smith", "Κυρία Άννα", 'k: "ABCDEFGHabcdefgh"', "f" * 32, "AKIA" + "A" * 16, "sk-" + "a" * 20, "xoxb-" + "a" * 10,
             "ghp_" + "a" * 36, "DE12ABCDABCDABCD", "1.2.3.4", "078-05-1120", "4111 1111 1111 1111", "3782 822463 10005", "4111111111111",
             "(017) 555 7713", "+1 555 77", "555.123.4567"]
    planted = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("planted", F.lit(True))
    rows = planted.unionByName(docs.select("text").withColumn("planted", F.lit(False)))
    matching = rows.where(F.col("text").rlike(pii.PATTERN))
    assert matching.where("planted").count() == len(texts) and matching.where(~pii.may_hold("text")).count() == 0
