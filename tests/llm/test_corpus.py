"""Mixing, sharding, top-k search and the pipeline."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import awkward, documents, empty, frame, key
from tidemark.llm import hamming_topk, mixing, sharding


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets(rows):
    size = Counter()
    for _, t, _, s, *_ in rows:
        size[s] += words(t)
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, got, free = 1.5 * sum(size.values()), {}, set(order)
    while free:
        unit = left / sum(w[s] for s in free)
        over = {s for s in free if unit * w[s] > 2 * size[s]}
        if not over:
            return size, got | {s: unit * w[s] for s in free}
        for s in over:
            got[s] = 2.0 * size[s]
            left -= got[s]
        free -= over
    return size, got


@pytest.mark.parametrize("name", ["awkward", "documents"])
def test_mixing(spark, sf_dir, name):
    rows = awkward() if name == "awkward" else documents(spark, sf_dir)
    got = mixing.mix(frame(spark, rows)).collect()
    size, want = targets(rows)
    assert key((r["doc_id"], r["size"]) for r in got) == key((d, words(t)) for d, t, *_ in rows)
    taken = Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and 0 <= r["rate"] <= 2
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        # Whole copies: one document of 20,000 words makes its source miss by up to half of that.
        assert abs(taken[s] - t) <= (max(0.02 * t, 60) if name == "documents" else 10_000)


def test_mixing_reruns_agree_and_copies_of_a_document_share(spark):
    rows = [(i, "one two three", None, "hot", None) for i in range(2000)] + [(10_000 + i, "x " * (i + 1), None, f"s{i % 5}", None) for i in range(200)]
    a, b = (mixing.mix(frame(spark, rows).repartition(n)) for n in (1, 7))
    assert key(a.select("doc_id", "taken").collect()) == key(b.select("doc_id", "taken").collect())
    hot = [r["copies"] for r in a.filter("source = 'hot'").collect()]
    assert max(hot) - min(hot) <= 1
    assert mixing.mix(empty(spark)).count() == 0


def test_rates_are_exponential_tilts(spark):
    rows = [(i, "w " * (1 + i % 50), None, "abc"[i % 3], None) for i in range(600)]
    got = [r for r in mixing.mix(frame(spark, rows)).collect() if 0 < r["rate"] < 2]
    by = defaultdict(dict)
    for r in got:
        by[r["source"]][r["size"]] = np.log(r["rate"] / (2 - r["rate"]))
    for odds in by.values():
        sizes = sorted(odds)
        slope = np.diff([odds[s] for s in sizes]) / np.diff(sizes)
        assert np.ptp(slope) < 1e-6


@pytest.mark.parametrize("n", [16, 3])
def test_sharding(spark, sf_dir, n):
    rows = [*awkward(), *documents(spark, sf_dir)]
    got = sharding.shard_by_bytes(frame(spark, rows), n).collect()
    want = key((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert key((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, sizes = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(n))
    total, largest = sum(sizes.values()), max(r["size"] for r in got)
    assert all(abs(sizes[s] - total / n) <= largest for s in range(n))


def test_sharding_is_contiguous_and_repeatable(spark, sf_dir):
    a, b = (sharding.op5_sharding(spark, sf_dir) for _ in range(2))
    assert key(a.collect()) == key(b.collect())
    assert sharding.shard_by_bytes(empty(spark)).count() == 0
    one = sharding.shard_by_bytes(frame(spark, [(1, "x", None, None, None)])).collect()
    assert len(one) == 1 and one[0]["slot"] == 0
    same = sharding.shard_by_bytes(frame(spark, [(i, "copy", None, None, None) for i in range(100)]), 4).collect()
    assert Counter(r["shard"] for r in same) == {0: 25, 1: 25, 2: 25, 3: 25}


def vectors(spark, n=300, d=64, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=d).tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(30)] + [(1000, None), (1001, []), (1002, [float("nan")] * d), (1003, [1.0] * (d // 2)), (40, rows[40][1]), (None, rows[5][1])]
    return rows, spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rank int, distance string")


def nearest(rows, queries, k):
    bits = [(i, np.array([x > 0 for x in v])) for i, v in rows if v and i is not None]
    out = []
    for q, v in {(i, b.tobytes()): (i, b) for i, b in bits if i in queries}.values():  # a repeated query is one
        near = sorted((int((v != b).sum()), i) for i, b in bits if i != q and len(b) == len(v))[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return key(out)


@pytest.mark.parametrize("params", [{}, {"shard_rows": 50}, {"segment_bits": 5}, {"segment_bits": 20, "k": 3}, {"segment_bits": 8, "shard_rows": 20, "k": 1}])
def test_topk(spark, params):
    """Query 40 is there twice, and copies of one vector crowd their shards."""
    rows, df = vectors(spark)
    got = hamming_topk.hamming_topk(df, df.filter("vec_id % 20 = 0"), **params)
    want = nearest(rows, {i for i, _ in rows if i is not None and i % 20 == 0}, params.get("k", 10))
    assert key(got.collect()) == want


def test_topk_of_an_id_with_several_codes(spark):
    rows, df = vectors(spark, n=60)
    more = spark.createDataFrame([(20, [-x for x in rows[20][1]], 1, "x")], df.schema)
    got = hamming_topk.hamming_topk(df.union(more), df.union(more).filter("vec_id = 20"), k=4)
    bits = lambda v: np.array([x > 0 for x in v])
    want = []
    for own in (rows[20][1], more.first()["embedding"]):
        near = sorted((int((bits(v) != bits(own)).sum()), i) for i, v in rows if v and i not in (None, 20) and len(v) == 64)[:4]
        want += [(20, n + 1, i, d) for n, (d, i) in enumerate(near)]
    assert key(got.collect()) == key(want)


def test_topk_sends_a_query_only_where_its_probes_lie(spark, monkeypatch):
    """Near queries retire after the first radius; nothing is sent to all shards."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[20][1]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sent = []
    write = hamming_topk.materialize

    def noted(frame, tag):
        out = write(frame, tag)
        if tag == "topk-live":
            sent.append(out.count())
        return out

    monkeypatch.setattr(hamming_topk, "materialize", noted)
    got = hamming_topk.hamming_topk(df, df.filter("vec_id = 20"), shard_rows=50)
    assert [(r["neighbour_id"], r["distance"]) for r in got.orderBy("rank").collect()] == [(1000 + i, 0) for i in range(10)] and sent == [1, 0]


@pytest.mark.parametrize(("d", "segment_bits"), [(20, 8), (12, 8), (36, 8), (28, 8)])
def test_topk_where_the_number_of_segments_is_rounded(spark, d, segment_bits):
    rng = np.random.default_rng(d)
    rows = [(i, rng.normal(size=d).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = hamming_topk.hamming_topk(df, df.filter("vec_id % 20 = 0"), k=3, segment_bits=segment_bits)
    assert key(got.collect()) == nearest(rows, set(range(0, 200, 20)), 3)


def test_topk_other_widths(spark):
    rows, df = vectors(spark, n=80, d=100, seed=2)
    got = hamming_topk.hamming_topk(df, df.filter("vec_id = 7"), k=500)
    assert key(got.collect()) == nearest(rows, {7}, 500)
    none = df.limit(0)
    assert hamming_topk.hamming_topk(none, none).count() == 0 and hamming_topk.hamming_topk(df, none).count() == 0


def test_stages_take_null_and_repeated_ids(spark, sf_dir):
    import corpus_pipeline as P
    from test_ngram_join import brute

    repeated = [(70, f"row {i} of one id has words of its own: {' '.join(f'w{i}x{j}' for j in range(12))}", "en", "d", 1) for i in range(4)]
    nulls = [(None, f"another null id {' '.join(f'n{i}x{j}' for j in range(12))}", "en", "e", 1) for i in range(4)] + [(None, "same words", "en", "e", 1)] * 2
    rows = [*awkward(), *repeated, *nulls, (50, "!!", "en", "a", 1)]
    docs = frame(spark, rows, clash=False)
    got = lambda stage: [tuple(r) for r in stage(spark, docs, sf_dir).collect()]
    lang = lambda r: (r[:2], r[3:])  # noqa: E731  without the language
    known = got(P.language_id)
    assert key(map(lang, known)) == key(lang(r) for r in rows if any(c.isalpha() for c in r[1] or ""))
    assert {r[2] for r in known} <= {"en", "de"} and all(r[2] == "en" for r in known if r[0] == 6)
    none = [tuple(r) for _, stage in P.STAGES for r in stage(spark, docs.limit(0), sf_dir).collect()]
    assert none == []
    kept, classes = got(P.drop_near_duplicates), defaultdict(list)
    for i, c, *_ in brute([(i, *r[1:]) for i, r in enumerate(rows)]):
        classes[c].append(rows[i])
    smallest = [min((r[0] for r in c if r[0] is not None), default=None) for c in classes.values()]
    assert sorted(map(str, (r[0] for r in kept))) == sorted(map(str, smallest)) and not Counter(kept) - Counter(rows)
    mixed, (size, want), taken = got(P.mix_sources), targets(rows), Counter()
    for r in mixed:
        taken[r[3]] += words(r[1])
    assert all(n <= 2 * Counter(rows)[r] for r, n in Counter(mixed).items())
    assert all(abs(taken[s] - t) <= (10_000 if s == "a" else 60) and taken[s] <= 2 * size[s] for s, t in want.items())
    planned = mixing.mix(docs).agg(F.sum("copies")).first()[0]
    assert len(mixed) == planned and any(r[0] is None for r in mixed)


def test_pipeline(spark, sf_dir, tmp_path):
    """Each stage on what the one before kept, against brute force."""
    import corpus_pipeline as P
    from test_dedup import lines
    from test_ngram_join import brute

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    step = {}
    for i, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{i}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{i}")
        step[name] = (before, docs)
        if name != "bpe":
            assert docs.columns == P.COLUMNS
    rows = lambda df: [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    a, b = map(rows, step["language_id"])
    assert key((d, t, s, n) for d, t, _, s, n in b) == key((d, t, s, n) for d, t, _, s, n in a if any(c.isalpha() for c in t))
    told, given = {d: x for d, _, x, *_ in b}, {d: x for d, _, x, *_ in a}
    assert np.mean([told[d] == given[d] for d in told if given[d]]) > 0.95
    a, b = map(rows, step["line_dedup"])
    assert key((d, t) for d, t, *_ in b) == key((d, t) for d, t, *_ in lines(a)) and all(len(t) == n for _, t, _, _, n in b)
    a, b = map(rows, step["ngram_jaccard_join"])
    assert sorted(r[0] for r in b) == sorted({r[1] for r in brute(a)})
    a, b = map(rows, step["mixing"])
    assert {r[0] for r in b} <= {r[0] for r in a} and max(Counter(r[0] for r in b).values()) <= 2
    size, want = targets(a)
    taken = Counter()
    for r in b:
        taken[r[3]] += words(r[1])
    assert all(abs(taken[s] - t) <= max(0.05 * t, 200) for s, t in want.items())  # a handful of documents per source
    before, after = step["bpe"]
    assert before.count() == after.count()
    joined = before.select("doc_id", F.sha2("text", 256).alias("h")).distinct().join(after, "doc_id")
    assert joined.filter("h <> decoded_sha256").count() == 0
    assert P.run(spark, sf_dir).count() == after.count()
