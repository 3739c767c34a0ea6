"""Exact, line and suffix dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import awkward, documents, empty, frame, key, prose
from tidemark.llm import exact_dedup as X
from tidemark.llm import line_dedup as L
from tidemark.llm import suffix_dedup as S

sha = lambda s: hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def exact(rows):
    norm = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t, *_ in rows]
    groups = defaultdict(list)
    for d, t in norm:
        groups[t].append(d)
    low = {t: min((x for x in ds if x is not None), default=None) for t, ds in groups.items()}
    return key((d, low[t], len(groups[t]), d == low[t], sha(t)) for d, t in norm)


@pytest.mark.parametrize("hash_fn", [X.content_hash, lambda t: F.pmod(F.length(t), F.lit(3))])
def test_exact(spark, hash_fn):
    """The second hash collides for nearly all texts."""
    assert key(X.exact_dedup(frame(spark), hash_fn=hash_fn).collect()) == exact(awkward())


def test_exact_on_documents(spark, sf_dir):
    assert key(X.op7_exact_dedup(spark, sf_dir).collect()) == exact(documents(spark, sf_dir))
    assert X.exact_dedup(empty(spark)).count() == 0


def lines(rows, n=40, docs=5):
    strip = " \t\n\x0b\x0c\r"
    fold = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(strip))
    holders = defaultdict(set)
    for d, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(fold(x)) >= n:
                holders[fold(x)].add(-1 if d is None else d)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= docs}
    out = []
    for d, t, *_ in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if fold(x) not in gone or gone[fold(x)] == d]
        out.append((d, "\n".join(kept), len(ls), len(ls) - len(kept)))
    return key(out)


@pytest.mark.parametrize(("batches", "fanout", "docs"), [(4, 2, 5), (1, 2, 5), (7, 3, 2)])
def test_lines(spark, batches, fanout, docs):
    got = L.line_dedup(frame(spark).drop("n_lines"), batches=batches, fanout=fanout, min_docs=docs)
    assert key(got.select("doc_id", "text", "n_lines", "n_dropped").collect()) == lines(awkward(), docs=docs)
    assert "lang" in got.columns and "size" in got.columns


def test_lines_on_documents(spark, sf_dir):
    want = key((d, n, k, sha(t)) for d, t, n, k in lines(documents(spark, sf_dir)))
    assert key(L.op2_line_dedup(spark, sf_dir).collect()) == want
    assert L.line_dedup(empty(spark)).count() == 0


def test_runs_are_levelled(spark):
    runs = L.LineRuns(spark, 2, fanout=2)
    sizes = []
    for i in range(5):
        runs.add(spark.createDataFrame([(bytearray([1]), 10 - i), (bytearray([2 + i]), 10 - i)], "h binary, doc_id long"))
        sizes.append([len(x) for x in runs.levels])
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    state = {bytes(r["h"]): (r["docs"], r["holder"]) for r in runs.state().collect()}
    assert state[b"\x01"] == (5, 10) and state[b"\x06"] == (1, 6)
    runs.close()


def suffixes(rows, n):
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    seen = Counter(b[p : p + n] for _, b in texts for p in range(len(b) - n + 1))
    out = []
    for d, b in texts:
        gone = S.merged([(p, p + n) for p in range(len(b) - n + 1) if seen[b[p : p + n]] > 1])
        kept, at = [], 0
        for x, y in gone:
            kept.append(b[at:x])
            at = y
        out.append((d, len(b), str(gone), b"".join([*kept, b[at:]])))
    return key(out)


def spans(df):
    return key((r["doc_id"], r["n_bytes"], str([(s["s"], s["e"]) for s in r["spans"]]), bytes(r["kept"])) for r in df.collect())


@pytest.mark.parametrize(("length", "cap"), [(200, 100_000), (64, 100_000), (64, 3)])
def test_suffixes(spark, length, cap):
    """A cap of 3 sends most starts through the grouping across the cluster."""
    rows = [*awkward(), (60, "ab" * 400, "x", "x", 1), (61, "a" * 500, "x", "x", 1), (62, "a" * 201 + "b", None, None, None)]
    assert spans(S.suffix_dedup(frame(spark, rows), length=length, cap=cap)) == suffixes(rows, length)


def test_suffixes_on_documents(spark, sf_dir):
    want = key((d, n, n - len(k), g.count("("), sha(k)) for d, n, g, k in suffixes(documents(spark, sf_dir), 200))
    assert key(S.op10_suffix_dedup(spark, sf_dir).collect()) == want
    assert S.suffix_dedup(empty(spark)).count() == 0


@pytest.mark.parametrize("step", [1000, 128, 900])
def test_anchors_beyond_the_bits_of_a_position(monkeypatch, step):
    """Positions of 10 bits: texts longer than that have the anchors they have with 24 bits."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 123, n).astype(np.uint8).tobytes() for n in (5000, 70, 10, 1024, 1025, 0, 3000)]
    texts[6] = texts[6][:2500] + texts[0][4000:4400] + b"a" * 300
    low = np.uint64((1 << 24) - 1024)  # bits that are position with 24 and hash with 10
    hashes = S.gram_hashes
    monkeypatch.setattr(S, "gram_hashes", lambda data: hashes(data) & ~low)
    want = S.text_anchors(texts, 64)
    monkeypatch.setattr(S, "STEP", step)
    monkeypatch.setattr(S, "_LOW", np.uint64(1023))
    got = S.text_anchors(texts, 64)
    assert [x.tolist() for x in got] == [x.tolist() for x in want]
    at = set(zip(want[0].tolist(), want[1].tolist(), strict=True))
    assert {p for d, p in at if d == 0 and p > 4000} and all(any((0, q) in at for q in range(p, p + 33)) for p in range(5000 - 63))


def test_uniform_text_has_few_rows():
    """Anchors at each byte or period become one run; the spans of a run overlap."""
    texts = [b"a" * 5000, b"ab" * 3000, b"0123456789" * 700]
    for t in texts:
        doc, pos, h = S.text_anchors([t], 200)
        c = np.frombuffer(b"".join(S.xxhash.xxh3_128_digest(t[max(0, p - 168) : p + 200], seed=min(p, 168)) for p in pos.tolist()), np.int64).reshape(-1, 2)
        first, last = S.runs(doc, pos, c, 200)
        assert len(pos) > 400 and len(first) < 400 and (last - first).max() > 100
        for i, j in zip(first.tolist(), last.tolist(), strict=True):
            assert (np.diff(pos[i : j + 1]) <= 200).all() and (c[i : j + 1] == c[i]).all()
    assert [len(x) for x in S.runs(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.int64), 200)] == [0, 0]


def test_texts_of_low_entropy(spark):
    rng = np.random.default_rng(2)
    texts = ["a" * 5000, "ab" * 3000, "a" * 900 + "b" + "a" * 900, "0123456789" * 700, "".join(rng.choice(["ab", "ba"], 1500)), "x" * 199, "x" * 200, " " * 400 + "word" + " " * 450]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    assert spans(S.suffix_dedup(frame(spark, rows))) == suffixes(rows, 200)


def test_repeats_beyond_16_mib(spark):
    rng = np.random.default_rng(8)
    long = rng.integers(97, 123, (1 << 24) + 5000).astype(np.uint8).tobytes().decode()
    passage = long[-1500:-1000]
    rows = [(1, long, None, None, None), (2, f"<{passage}>", None, None, None)]
    got = {r["doc_id"]: [(s["s"], s["e"]) for s in r["spans"]] for r in S.suffix_dedup(frame(spark, rows)).select("doc_id", "spans").collect()}
    assert got == {1: [(len(long) - 1500, len(long) - 1000)], 2: [(1, 501)]}


@given(st.lists(st.lists(st.integers(0, 2), min_size=3, max_size=3), max_size=40))
@settings(max_examples=50, deadline=None)
def test_multikey_order(rows):
    words = np.array(rows, np.uint64).reshape(-1, 3)
    order, equal = S.multikey_order(words, np.zeros(len(words), np.int64))
    assert [rows[i] for i in order] == sorted(rows)
    assert equal.tolist() == [rows.count(r) > 1 for r in rows]


@pytest.mark.parametrize(("few", "large"), [(12, 1500), (1, 1500), (12, 40), (1000, 1500), (1, 2)])
def test_windows_whatever_the_group_size(few, large):
    rng = np.random.default_rng(3)
    sizes, back = [2, 5, 13, 60, 1], 168
    blocks = []
    for g in sizes:
        m = np.repeat(rng.integers(97, 100, (1, 368)).astype(np.uint8), g, 0)
        for i in range(g):
            for p in rng.integers(0, 368, rng.integers(0, 4)):
                if not back <= p < back + 32:
                    m[i, p] = rng.integers(97, 100)
        blocks.append(m)
    m, group = np.concatenate(blocks), np.repeat(np.arange(len(sizes)), sizes)
    hi, lo = rng.integers(90, 169, len(m)), np.maximum(0, rng.integers(-200, 60, len(m)))
    want = np.zeros((len(m), back + 1), bool)
    for g in range(len(sizes)):
        for o in range(back + 1):
            rows = [i for i in np.nonzero(group == g)[0] if lo[i] <= o <= hi[i]]
            n = Counter(m[i, back - o : back - o + 200].tobytes() for i in rows)
            for i in rows:
                want[i, o] = n[m[i, back - o : back - o + 200].tobytes()] > 1
    assert (S.repeated_windows(m, lo, hi, group, 200, few, large) == want).all()


def test_no_run_stays_behind_when_a_batch_fails(spark, monkeypatch):
    merged = L.LineRuns._merged
    monkeypatch.setattr(L.LineRuns, "_merged", lambda self, names: merged(self, names).selectExpr("h", "docs", "assert_true(docs < 0) IS NULL AS holder"))
    rows = [(i, "\n".join([prose(12, i % 3), prose(12, 50 + i)]), None, None, None) for i in range(20)]
    with pytest.raises(Exception, match="docs < 0"):
        L.line_dedup(frame(spark, rows)).count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_steps_clean_up_their_shuffles_and_leave_the_session_alone(spark):
    from tidemark.llm.common import materialize, swept

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with swept(spark):
        assert spark.conf.get(key) == "true"
    materialize(spark.range(10).groupBy("id").count(), "test")
    assert spark.conf.get(key, None) == before


def test_runs_are_joined_where_they_lie(spark, monkeypatch):
    """A batch is shuffled for itself only; the runs are read bucket by bucket."""
    plans, write = [], L.LineRuns._write

    def noted(self, rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, rows)

    monkeypatch.setattr(L.LineRuns, "_write", noted)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = L.LineRuns(spark, 8, fanout=3)
        for i in range(3):
            runs.add(spark.createDataFrame([(bytearray([1]), 10 - i)], "h binary, doc_id long"))
        runs.close()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plans[2].count("SortMergeJoin") == 2 and all(p.count("Exchange hashpartitioning") == 2 for p in plans[:3])
