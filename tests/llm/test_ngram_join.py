"""The similarity join against all pairs."""

import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest

from helpers import awkward, documents, empty, frame, key, prose
from tidemark.llm import ngram_join as J
from tidemark.llm.common import components


def grams(t, n=5):
    w = (t or "").lower().split()
    k = min(n, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute(rows, threshold=0.8):
    copies = defaultdict(list)
    for d, t, *_ in rows:
        copies[" ".join((t or "").lower().split())].append(d)
    low = {t: min((x for x in ds if x is not None), default=None) for t, ds in copies.items()}
    sets = {t: grams(t) for t in copies}
    up = {t: t for t in copies}

    def top(t):
        while up[t] != t:
            t = up[t]
        return t

    links = Counter()
    for a, b in itertools.combinations(copies, 2):
        common = len(sets[a] & sets[b])
        if common and common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
            links[a] += 1
            links[b] += 1
            up[top(a)] = top(b)
    members = defaultdict(list)
    for t in copies:
        members[top(t)].append(t)
    out = []
    for d, t, *_ in rows:
        t = " ".join((t or "").lower().split())
        cls = members[top(t)]
        ids = [low[x] for x in cls if low[x] is not None]
        out.append((d, min(ids, default=None), sum(len(copies[x]) for x in cls), low[t], len(copies[t]), links[t]))
    return key(out)


@pytest.mark.parametrize("params", [{}, {"cap": 3, "pilots": 1}, {"block_docs": 2, "block_words": 300}, {"cap": 2, "pilots": 2, "block_docs": 1}])
def test_join(spark, params):
    assert key(J.ngram_join(frame(spark), **params).collect()) == brute(awkward())


def test_join_on_documents(spark, sf_dir):
    assert key(J.op6_ngram_join(spark, sf_dir).collect()) == brute(documents(spark, sf_dir))
    assert J.ngram_join(empty(spark)).count() == 0


def test_a_large_loose_group(spark):
    """Edits of one text, most pairs of which are no links, in trie nodes above the cap."""
    base = prose(150, 9).split()
    rng = np.random.default_rng(1)
    rows = []
    for i in range(120):
        w = list(base)
        for p in rng.integers(0, len(w), rng.integers(0, 9)):
            w[p] = f"edit{rng.integers(10_000)}"
        rows.append((i, " ".join(w), None, None, None))
    got = key(J.ngram_join(frame(spark, rows), cap=40, pilots=4, block_docs=50).collect())
    assert got == brute(rows)


def test_depth_is_shortened_until_the_recall():
    assert J.forest_depth(0.8, 16, 7, 0.999) == 4
    assert 1 - (1 - 0.8 ** J.forest_depth(0.8, 16, 7, 0.999)) ** 16 >= 0.999
    assert J.forest_depth(0.99, 16, 7, 0.9) == 7


def test_prefixes_in_dense_tries_are_shortened_until_the_recall():
    ask = lambda depths: J.ask_depth(16 - len(depths), depths, 4, 7, 0.8, 0.999)
    assert ask([]) == ask([0]) == ask([0, 0]) == 0  # the other tries suffice
    assert ask([0] * 16) == 4 and ask([0] * 8) == 5 and ask([7] * 16) == 4 and ask([0] * 4) in (6, 7)
    for depths in ([0] * 3, [5, 0, 0], [7] * 9, [5] * 16):
        d = ask(depths)
        met = [4] * (16 - len(depths)) + [min(x or 9, d or 9) for x in depths]
        assert np.prod([1 - 0.8**x if x < 9 else 1 for x in met]) <= 0.001


def test_forest_edges_are_few():
    sketch = np.zeros((50, 112), np.uint16)
    pilots = np.zeros(50, bool)
    pilots[:3] = True
    edges, todo = J.canopy(sketch, pilots, 0.5)
    assert len(edges) == 49 and not todo.any() and len(J.near(sketch, 0.3)) == 49
    sketch[25:] = 1
    assert len(J.near(sketch, 0.3)) == 48


@pytest.mark.parametrize("size", [600, 1200, 2400, 4800])
def test_edges_of_a_group_grow_with_its_texts(size):
    """Blocks and pairs of blocks of texts that all resemble each other."""
    blocks = [range(i, min(i + 512, size)) for i in range(0, size, 512)]
    total, links = 0, 0
    for i, x in enumerate(blocks):
        for y in blocks[i:]:
            rows = sorted({*x, *y})
            linked = ~np.eye(len(rows), dtype=bool)
            n, edges = J.block_edges(linked, np.array([r in x for r in rows]))
            total, links = total + len(edges), links + int(n.sum())
    assert links == size * (size - 1) and total <= 1.2 * size


def test_a_dense_group_of_near_copies(spark):
    """A third of the texts differ in a word each: all pairs are links, and all tries are dense."""
    base = prose(200, 3).split()
    rows = [(i, " ".join([*base[: i % 190], f"word{i}", *base[i % 190 + 1 :]]), None, None, None) for i in range(900)]
    rows += [(1000 + i, prose(40, 500 + i), None, None, None) for i in range(1800)]
    got = J.ngram_join(frame(spark, rows), cap=64, block_docs=100).filter("doc_id < 1000").collect()
    assert {(r["class_id"], r["class_size"], r["n_links"]) for r in got} == {(0, 900, 899)} and len(got) == 900


def joined_rows(spark, work):
    """What ``work`` returns, and the rows that all joins made in it."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = store.executionsCount()
    out = work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    made, runs = 0, store.executionsList()
    for i in range(before, runs.size()):
        at = runs.apply(i).executionId()
        values, nodes = store.executionMetrics(at), store.planGraph(at).allNodes()
        for node in (nodes.apply(n) for n in range(nodes.size())):
            if "Join" in node.name():
                metrics = (node.metrics().apply(m) for m in range(node.metrics().size()))
                rows = [values.get(m.accumulatorId()) for m in metrics if m.name() == "number of output rows"]
                made += sum(int(r.get().replace(",", "")) for r in rows if r.isDefined())
    return out, made


def smallest(edges):
    up = {x: x for e in edges for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    return {x: top(x) for x in up}


def test_components_of_many_shapes(spark):
    """Paths in order and at random, a star, loops, repeated edges, nothing."""
    order = np.random.default_rng(2).permutation(100) + 1000
    edges = [(i, i + 1) for i in range(60)] + [(int(x), int(y)) for x, y in itertools.pairwise(order)] + [(2050, 2000 + i) for i in range(100)]
    edges += [(3000, 3000), (3001, 3002), (3002, 3001), (3001, 3002)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "shapes").collect()
    assert sorted((r["id"], r["label"]) for r in got) == sorted(smallest(edges).items())
    assert components(spark.createDataFrame([], "a long, b long"), "none").count() == 0


def test_components_join_all_edges_in_one_round_only(spark):
    """A group of near copies as 16 tries link it: forests over the same texts."""
    rng = np.random.default_rng(4)
    edges = []
    for _ in range(16):
        part = rng.integers(0, 12, 1500)
        for p in range(12):
            members = rng.permutation(np.nonzero(part == p)[0])
            edges += [(int(members[0]), int(m)) for m in members[1:]]
    labels, made = joined_rows(spark, lambda: components(spark.createDataFrame(edges, "a long, b long"), "group").collect())
    assert {r["id"]: r["label"] for r in labels} == smallest(edges)
    assert 0 < made < 3 * len(edges)
