"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

1. Texts with the same words are one class (a copy group); only its smallest id
   takes part in what follows, so copies are never expanded into pairs.
2. Each of ``trees`` prefix tries holds the signatures as (tree, prefix), sorted
   by the shuffle; a trie node is a run of texts with the same prefix.
   ``base_depth`` is the longest prefix at which a pair at the threshold meets
   in some trie with probability ``recall``.  Where a node of that depth is
   dense (more than ``cap`` texts), its texts go on with the longest prefix,
   ``max_depth`` values, and each text shortens it only until its own recall,
   ``1 - prod(1 - threshold ** depth)`` over all tries, reaches the target.  A text
   whose other tries suffice never looks into a dense node.
3. Members of a node are compared by sketch and linked by a spanning forest.
   Nodes above ``cap`` members are dealt into blocks that share pilot leaders: a
   member within ``NEAR`` of a pilot needs no leader of its own, since by the
   triangle inequality whatever resembles it lies within ``NEAR`` + the
   threshold's distance of that pilot, and that is linked to the pilot too;
   members far from all pilots go through further rounds until none is left over.
4. Connected candidates are verified exactly on their whole shingle sets, in
   blocks; a component of many blocks is compared block by block.  A block
   gives a spanning forest, a pair of blocks a forest over the parts that the
   two already form, so that edges grow with the texts and not with the pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import _batches
from .common import bound_batches, components, discard, materialize, table

#: Sketch distances: of a pilot's own members, and the noise allowed on top of the threshold's distance (four sigma of 112 values).
NEAR, NOISE = 0.25, 0.16
#: Words remembered by one worker; longer ones are hashed each time.
MEMO, MEMO_CHARS = 400_000, 64
#: Bytes of a signature's value; chance equality of 1 in 65,536 adds a candidate at most.
VALUE = 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Shingle hashes of texts; words are lower-cased and split at white space."""

    def __init__(self, n: int):
        self.n, self.memo = n, {}

    def words(self, text: str) -> tuple[np.ndarray, bytes]:
        """64-bit hashes of the words, and a 128-bit hash of the whole sequence."""
        words = text.lower().split()
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        long = {}
        for w in set(words).difference(memo):
            (memo if len(w) <= MEMO_CHARS else long)[w] = xxhash.xxh3_64_intdigest(w)
        get = (lambda w: memo[w] if len(w) <= MEMO_CHARS else long[w]) if long else memo.__getitem__
        return np.fromiter(map(get, words), np.uint64, len(words)), hashlib.md5(" ".join(words).encode()).digest()

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """One hash per shingle, repeats included; a text with fewer words than a shingle is one shingle."""
        if not len(words):
            return words
        n = min(self.n, len(words))
        h = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            h = (h ^ words[i : len(words) - n + 1 + i]) * _MIX
            h ^= h >> np.uint64(29)
        return h * np.uint64(0xBF58476D1CE4E5B9)


def forest_depth(threshold: float, trees: int, max_depth: int, recall: float) -> int:
    """Longest prefix at which a pair at the threshold meets in some trie with probability ``recall``."""
    depth = max_depth
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048]
        np.minimum(out, (part[None, :] * a[:, None] + b[:, None]).min(axis=1), out=out)
    return (out >> np.uint64(24)).astype(">u2")


def ask_depth(open_trees: int, depths: list[int], base_depth: int, max_depth: int, threshold: float, recall: float) -> int:
    """How far a text shortens its prefixes in dense tries: 0 if not at all.

    In ``open_trees`` tries it has met all at ``base_depth``, in others at ``depths`` below dense nodes; the rest are dense throughout.
    The longest prefix that reaches ``recall`` when it is met in every dense trie."""
    for depth in [0, *range(max_depth, base_depth, -1)]:
        miss = (1 - threshold**base_depth) ** open_trees
        for d in depths:
            d = min(d, depth) if depth and d else d or depth
            miss *= 1 - threshold**d if d else 1
        if miss <= 1 - recall:
            return depth
    return base_depth


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows with equal values in the first ``keys`` columns, across batch borders."""
    held: list[pa.Table] = []
    for b in batches:
        t = pa.Table.from_batches([b])
        if not t.num_rows:
            continue
        if held:
            t = pa.concat_tables([*held, t])
        cols = [t.column(i).combine_chunks() for i in range(keys)]
        change = np.zeros(t.num_rows - 1, bool)
        for c in cols:
            change |= ~np.asarray(pa.compute.equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False), bool)
        cuts = [0, *(np.nonzero(change)[0] + 1).tolist()]
        t = t.combine_chunks()
        for s, e in zip(cuts, cuts[1:], strict=False):
            yield t.slice(s, e - s)
        held = [t.slice(cuts[-1])]
    if held:
        yield held[0]


def _sketches(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint16).reshape(len(rows), -1)


def near(sketch: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """A spanning forest of the rows within ``reach`` of each other."""
    edges, left = [], np.arange(len(sketch))
    front: list[int] = []
    while len(left):
        if not front:
            front, left = [int(left[0])], left[1:]
            continue
        i = front.pop()
        close = (sketch[left] != sketch[i]).mean(axis=1) <= reach
        edges += [(i, j) for j in left[close].tolist()]
        front += left[close].tolist()
        left = left[~close]
    return edges


def canopy(sketch: np.ndarray, pilots: np.ndarray, reach: float) -> tuple[list[tuple[int, int]], np.ndarray]:
    """A forest over what pilots link within ``reach``, and the members far from all pilots.

    A member joins the forest by one edge at most, however many pilots it resembles."""
    edges, todo, label = [], np.ones(len(sketch), bool), np.arange(len(sketch))
    for i in np.nonzero(pilots)[0].tolist():
        d = (sketch != sketch[i]).mean(axis=1)
        close = np.nonzero((d <= reach) & (label != label[i]))[0]
        labels, first = np.unique(label[close], return_index=True)
        edges += [(i, int(close[j])) for j in first]
        label[np.isin(label, labels)] = label[i]
        todo &= d > NEAR
    return edges, todo


def _verify(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs are linked."""
    g = len(sets)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(g), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    same = flat[1:] == flat[:-1]
    shared = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(flat) else np.zeros(0, bool)
    column = np.cumsum(np.concatenate([[True], ~same])[shared]) - 1 if shared.any() else np.zeros(0, np.int64)
    owner, inter = owner[shared], np.zeros((g, g), np.float32)
    at = 0
    while at < len(column):  # the columns are ascending: a slice of 4096 of them at a time
        to = int(np.searchsorted(column, column[at] + 4096))
        m = np.zeros((g, 4096), np.float32)
        m[owner[at:to], column[at:to] - column[at]] = 1
        inter += m @ m.T
        at = to
    size = np.array([len(s) for s in sets], np.float32)
    linked = (inter > 0) & (inter >= threshold * (size[:, None] + size[None, :] - inter) - 1e-3)
    np.fill_diagonal(linked, False)
    return linked


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (root, member) that connect what the matrix connects."""
    edges, todo = [], linked.any(axis=1)
    while todo.any():
        root = int(todo.argmax())
        reached = np.zeros(len(linked), bool)
        front = np.zeros(len(linked), bool)
        front[root] = reached[root] = True
        while front.any():
            front = linked[front].any(axis=0) & ~reached
            reached |= front
        edges += [(root, j) for j in np.nonzero(reached)[0].tolist() if j != root]
        todo &= ~reached
    return edges


def _parts(n: int, edges: list[tuple[int, int]]) -> np.ndarray:
    """The root of each of ``n`` rows under a forest of (root, member)."""
    root = np.arange(n)
    for r, j in edges:
        root[j] = r
    return root


def block_edges(linked: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links per row that this cell counts, and its edges.

    A block by itself (all ``left``) counts all links and gives a spanning forest.  A pair of blocks counts the links
    across; its edges join the parts that each block forms by itself, which the blocks' own cells give the forests of."""
    if left.all():
        return linked.sum(axis=1), _forest(linked)
    across = linked & (left[:, None] != left[None, :])
    root = _parts(len(left), _forest(linked & (left[:, None] == left[None, :])))
    heads, of = np.unique(root, return_inverse=True)
    joined = np.zeros((len(heads), len(heads)), bool)
    x, y = np.nonzero(across)
    joined[of[x], of[y]] = True
    return across.sum(axis=1), [(int(heads[p]), int(heads[q])) for p, q in _forest(joined)]


def ngram_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    trees: int = 16,
    max_depth: int = 7,
    recall: float = 0.999,
    cap: int = 512,
    pilots: int = 16,
    block_docs: int = 512,
    block_words: int = 400_000,
) -> DataFrame:
    """``doc_id, class_id, class_size, copy_id, copies, n_links``, one row per input row.

    ``copy_id`` is the smallest id with the same words and ``copies`` their
    number; ``n_links`` counts the other copy groups at Jaccard similarity of at
    least ``threshold``; ``class_id`` is the smallest id that links connect.
    Links are exact on what is found; a pair at the threshold is found with
    probability ``recall`` or more.  Ids are integers.  Texts without words (null, empty) are
    copies of each other and have no links.  Rows repeating an id are rows of
    their own; a null id is never the smallest; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    base_depth = forest_depth(threshold, trees, max_depth, recall)
    rng = np.random.default_rng(20_240_517)
    a = rng.integers(0, 1 << 63, trees * max_depth, np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, trees * max_depth, np.uint64)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def sign_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            for texts, ids in _batches(batch.column(1), batch.column(0)):
                copy, size, sign = [], [], []
                for text in texts:
                    words, whole = shingler.words(text)
                    copy.append(whole)
                    size.append(len(words))
                    if not len(words):
                        sign.append(None)
                        continue
                    sign.append(signature(shingler.shingles(words), a, b).tobytes())
                columns = [ids, pa.array(copy, pa.binary()), pa.array(size, pa.int64()), pa.array(sign, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "copy", "words", "sign"])

    signed = materialize(rows.mapInArrow(sign_texts, "doc_id long, copy binary, words long, sign binary"), "forest-signed")
    copies = materialize(signed.groupBy("copy").agg(F.min("doc_id").alias("copy_id"), F.count("*").alias("copies")), "forest-copies")
    lead = signed.join(copies, (signed["copy"] == copies["copy"]) & signed["doc_id"].eqNullSafe(copies["copy_id"])).select(signed["copy"].alias("node"), "doc_id", "words", "sign")
    nodes = materialize(lead.dropDuplicates(["node"]).filter("words > 0"), "forest-nodes")

    # The tries: (tree, prefix) of each text; a key is a node of one trie at one depth.
    def key(depth: int) -> Column:
        return F.xxhash64("tree", F.substring("prefix", 1, VALUE * depth))

    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    prefix = F.expr(f"substring(sign, tree * {VALUE * max_depth} + 1, {VALUE * max_depth})").alias("prefix")
    leaves = nodes.select("node", "sign", tree).select("node", "tree", prefix)

    def met(at: DataFrame, depth: int) -> DataFrame:
        """Rows of ``at`` in nodes of this depth with two members or more, and the number of members."""
        keyed = at.withColumn("key", key(depth))
        return keyed.join(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key")

    base = materialize(met(leaves, base_depth), "forest-met")
    waiting = base.filter(F.col("n") <= cap).select("node", "key")
    dense = materialize(base.filter(F.col("n") > cap).select("node", "tree", "prefix"), "forest-dense")
    parts: list[DataFrame] = [base, dense]
    if not dense.isEmpty():
        # Below dense nodes, from the longest prefix on: ``at`` is the shortest whose node is not dense (0: none is), ``had`` its members.
        rest, settled = dense.withColumns({"at": F.lit(0), "had": F.lit(0).cast("long")}), []
        for depth in range(max_depth, base_depth, -1):
            count = dense.groupBy(key(depth).alias("key")).agg(F.count("*").alias("n"))
            held = materialize(rest.withColumn("key", key(depth)).join(count, "key"), "forest-deeper")
            parts.append(held)
            settled.append((held.filter(F.col("n") > cap), depth + 1))
            rest = held.filter(F.col("n") <= cap).select("node", "tree", "prefix", F.lit(depth).alias("at"), F.col("n").alias("had"))
        settled.append((rest, base_depth + 1))
        for rows_at, depth in settled:
            waiting = waiting.union(rows_at.filter("had > 1").select("node", key(depth).alias("key")))
        found_at = reduce(DataFrame.union, (rows_at.select("node", F.col("at").alias("depth")) for rows_at, _ in settled))
        # Each text shortens its prefixes until its recall reaches the target: one row per text, of at most ``trees`` depths.
        asks = F.udf(lambda depths: ask_depth(trees - len(depths), depths, base_depth, max_depth, threshold, recall), "int")
        kinds = found_at.groupBy("node").agg(F.sort_array(F.collect_list("depth")).alias("depths"))
        ask = kinds.groupBy("depths").agg(F.count("*").alias("n")).select("depths", asks("depths").alias("ask")).filter("ask > 0")
        asked = materialize(dense.join(kinds, "node").join(ask, "depths").select("node", "tree", "prefix", "ask"), "forest-asked")
        parts.append(asked)
        for depth in [r["ask"] for r in asked.select("ask").distinct().collect()]:  # depths of a trie
            opened = asked.filter(F.col("ask") == depth).select(key(depth).alias("key")).distinct()
            waiting = waiting.union(dense.select("node", key(depth).alias("key")).join(opened, "key", "left_semi").select("node", "key"))
    spread = waiting
    waiting = materialize(spread.distinct() if len(parts) > 2 else spread, "forest-waiting")
    discard(*parts)
    reach = 1 - threshold + NOISE
    schema = "a binary, b binary, key long"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64())], names=["a", "b", "key"])

        for g in _groups(batches, 2):
            node, pilot = g.column("node").to_pylist(), np.array(g.column("pilot").to_pylist(), bool)
            sketch = _sketches(g.column("sign"))
            if not pilot.any():
                out += [(node[i], node[j], None) for i, j in near(sketch, reach)]
            else:
                links, todo = canopy(sketch, pilot, NEAR + reach)
                out += [(node[i], node[j], None) for i, j in links]
                name = g.column("key")[0].as_py()
                out += [(node[i], None, name) for i in np.nonzero(todo)[0].tolist()]
            if len(out) > 20_000:
                yield flush()
        yield flush()

    edges: DataFrame | None = None
    spent: list[DataFrame] = []
    while True:
        count = waiting.groupBy("key").agg(F.count("*").alias("n"))
        large = materialize(count.filter(F.col("n") > cap), "forest-large")
        some = not large.isEmpty()
        few = (waiting.join(large, "key", "left_anti") if some else waiting).select("key", F.lit(0).alias("sub"), "node", F.lit(False).alias("pilot"))
        if some:
            h = F.xxhash64("node")
            held = waiting.join(large, "key").withColumn("subs", F.ceil(F.col("n") / cap).cast("int"))
            own = held.select("key", F.pmod(h, F.col("subs")).cast("int").alias("sub"), "node", F.lit(False).alias("pilot"))
            some_nodes = F.collect_set(F.when(F.pmod(h, F.col("n")) < 4 * pilots, F.col("node")))  # bounded: about 4 * pilots of n
            first = held.groupBy("key").agg(F.first("subs").alias("subs"), F.slice(F.sort_array(some_nodes), 1, pilots).alias("nodes"))
            lone = held.groupBy("key").agg(F.min("node").alias("node"), F.first("subs").alias("subs"))
            led = first.select("key", "subs", F.explode("nodes").alias("node")).union(lone.select("key", "subs", "node")).distinct()
            led = led.select("key", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), "node", F.lit(True).alias("pilot"))
            few = few.union(own).union(led)
        dealt = few.join(nodes.select("node", F.col("sign")), "node").select("key", "sub", "node", "pilot", "sign")
        found = materialize(dealt.repartition("key", "sub").sortWithinPartitions("key", "sub", "pilot", "node").mapInArrow(compare, schema), "forest-links")
        links = found.filter("b IS NOT NULL AND a <> b").select("a", "b")
        edges = links if edges is None else edges.union(links)
        spent.append(found)
        discard(waiting, large)
        waiting = found.filter("b IS NULL").select("key", F.col("a").alias("node")).distinct()
        if not some:
            break
        waiting = materialize(waiting, "forest-met")
    label = components(edges, "forest-near")
    discard(*spent)

    # Exact verification inside candidate components.
    member = nodes.select("node", "doc_id", "words").join(label.withColumnRenamed("id", "node").withColumnRenamed("label", "comp"), "node")
    extent = member.groupBy("comp").agg(F.greatest(F.ceil(F.count("*") / block_docs), F.ceil(F.sum("words") / block_words)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    member = member.join(extent, "comp").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    some_id = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id")  # null ids join like any other; the node tells texts of one id apart
    member = member.select("comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", some_id)
    member = materialize(member, "forest-members")
    discard(nodes)
    wanted = member.select("doc_id").distinct()
    texts = materialize(rows.select(some_id, "text").join(wanted, "doc_id", "left_semi"), "forest-texts")
    posed = member.join(texts, "doc_id").select("comp", "i", "j", "own", "node", "text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for g in _groups(batches, 3):
            i, j = g.column("i")[0].as_py(), g.column("j")[0].as_py()
            sets, names, side = [], {}, []
            for node, own, text in zip(g.column("node"), g.column("own"), g.column("text"), strict=True):
                node = node.as_py()
                if node in names:
                    continue
                words, whole = shingler.words(text.as_py())
                if whole == node:  # else another text under the same id
                    names[node] = len(sets)
                    sets.append(np.unique(shingler.shingles(words)))
                    side.append(own.as_py() == i)
            if len(sets) < 2:
                continue
            left = np.array(side)
            if i != j and left.all() == left.any():  # one side only
                continue
            links, edges = block_edges(_verify(sets, threshold), left)
            names = list(names)
            hit = np.nonzero(links)[0].tolist()
            first = [names[x] for x in hit] + [names[x] for x, _ in edges]
            second = [None] * len(hit) + [names[y] for _, y in edges]
            count = [int(links[x]) for x in hit] + [0] * len(edges)
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.binary()), pa.array(second, pa.binary()), pa.array(count, pa.int64())], names=["a", "b", "links"])

    checked = posed.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j").mapInArrow(verify, "a binary, b binary, links long")
    checked = materialize(checked, "forest-verified")
    discard(member, texts)
    degree = checked.filter("b IS NULL").groupBy(F.col("a").alias("copy")).agg(F.sum("links").alias("n_links"))
    joined = components(checked.filter("b IS NOT NULL").select("a", "b"), "forest-class").withColumnRenamed("id", "copy")
    known = copies.join(joined, "copy", "left").join(degree, "copy", "left").withColumn("label", F.coalesce("label", "copy"))
    known = materialize(known, "forest-known")
    discard(checked, copies)
    classes = known.groupBy("label").agg(F.min("copy_id").alias("class_id"), F.sum("copies").alias("class_size"))
    classed = known.join(classes, "label").select("copy", "copy_id", "copies", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return signed.select("doc_id", "copy").join(classed, "copy").select("doc_id", "class_id", "class_size", "copy_id", "copies", "n_links")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))
