"""Language ID by cross-parsing entropy.

For each language a suffix automaton of labelled text is built.  A text is
parsed greedily into the longest phrases that occur in that labelled text; the
entropy estimate is phrases * log2(size of labelled text) / symbols, and the
language with the lowest wins.

The automaton is laid out as a dense table whose missing transitions restart at
the root and count a phrase, so that parsing is one table lookup per symbol;
numpy walks thousands of blocks of text in step.  Only the most frequent symbols
of a language have columns there; transitions of all others are looked up in a
sorted list.  The labelled text is a bounded sample (``train_symbols`` per
language), so the tables grow with the number of languages only and are
broadcast.  All texts are parsed whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import _batches
from .common import bound_batches, share, table

#: Symbols of a text that are parsed as one block; blocks are parsed side by side.
BLOCK = 1024
#: Symbols in blocks that are parsed at once, their padding included.
MATRIX = 1 << 21
SPACE = 32
#: Cells of the dense tables of all languages together; more languages have fewer dense columns each.
CELLS = 1 << 27


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the root."""
    to, link, length, last = [{}], [-1], [0], 0
    for c in text:
        cur, p = len(to), last
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        while p >= 0 and c not in to[p]:
            to[p][c] = cur
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(to)
                to.append(dict(to[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return to


class LanguageTable:
    """The table of one language: entry = (next state's row << 1) | 1 if a phrase starts with this symbol.

    The ``dense - 1`` most frequent symbols have columns; other transitions are in ``keys`` (state and code, ascending) and ``entries``."""

    def __init__(self, lang: str, symbols: np.ndarray, dense: int):
        self.lang, self.size = lang, max(2, len(symbols))
        known = [c for c, _ in Counter(symbols.tolist()).most_common()]
        self.n = len(known) + 1
        self.k = min(self.n, max(1, dense))
        self.code = np.zeros(max(known, default=0) + 2, np.min_scalar_type(self.n))  # 0: a symbol that the labelled text doesn't have; the last: any beyond
        self.code[known] = np.arange(1, self.n)
        to = suffix_automaton(self.code[symbols].tolist())
        root = np.ones(self.n, np.int32)
        for c, s in to[0].items():
            root[c] = (s * self.k) << 1 | 1
        table, sparse = np.tile(root[: self.k], (len(to), 1)), {}
        for s, out in enumerate(to[1:], 1):
            for c, t in out.items():
                if c < self.k:
                    table[s, c] = (t * self.k) << 1
                else:
                    sparse[s * self.n + c] = (t * self.k) << 1
        self.table, self.root = table.ravel(), root
        self.keys = np.array([*sorted(sparse), np.iinfo(np.int64).max], np.int64)
        self.entries = np.array([*(sparse[x] for x in self.keys[:-1].tolist()), 0], np.int32)

    def _sparse(self, at: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Entries for symbols without a column."""
        key = at.astype(np.int64) // self.k * self.n + code
        found = np.searchsorted(self.keys, key)
        return np.where(self.keys[found] == key, self.entries[found], self.root[code])

    def phrases(self, blocks: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases of each column of ``blocks`` (symbols by step); the first ``active[t]`` columns are still going at step t."""
        at, n = np.zeros(blocks.shape[1], np.int32), np.zeros(blocks.shape[1], np.int32)
        coded = self.code[np.minimum(blocks, len(self.code) - 1)]
        row, column = np.nonzero(coded >= self.k)
        rare = coded[row, column].astype(np.int64)
        coded[row, column] = 0
        cuts = np.searchsorted(row, np.arange(len(coded) + 1)).tolist()
        for t, m in enumerate(active.tolist()):
            step = self.table.take(at[:m] + coded[t, :m])
            if cuts[t] < cuts[t + 1]:
                c, r = column[cuts[t] : cuts[t + 1]], rare[cuts[t] : cuts[t + 1]]
                c, r = c[c < m], r[c < m]
                step[c] = self._sparse(at[c], r)
            n[:m] += step & 1
            at[:m] = step >> 1
        return n


_LETTER = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
    return _LETTER


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters with runs of anything else as one space, concatenated; and the symbols per text (0: no letters)."""
    low = [x.lower() for x in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(x) for x in low])
    letter = _letters()[code]
    starts = np.zeros(len(code), bool)
    starts[np.concatenate([[0], ends[:-1]]).astype(np.int64).clip(max=max(0, len(code) - 1))] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1] & ~starts[1:]  # the first symbol of a run between words
    before = np.concatenate([[0], np.cumsum(keep)])
    lettered = np.concatenate([[0], np.cumsum(letter)])
    first = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    n = before[ends] - before[first]
    n[lettered[ends] == lettered[first]] = 0
    return np.where(letter, code, SPACE).astype(np.uint32)[keep], n


def parse(tables: list[LanguageTable], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bits per symbol, texts by languages; and the symbols per text."""
    flat, n = symbols(texts)
    bits = np.full((len(texts), len(tables)), np.inf)
    if not len(flat):
        return bits, n
    # Blocks of all texts, longest first, as columns.
    count = -(-n // BLOCK)
    owner = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begin = (np.cumsum(n) - n)[owner] + nth * BLOCK
    size = np.minimum(BLOCK, n[owner] - nth * BLOCK)
    order = np.argsort(-size, kind="stable")
    owner, begin, size = owner[order], begin[order], size[order]
    padded, phrases, at = np.concatenate([flat, np.zeros(BLOCK, np.uint32)]), np.zeros((len(tables), len(texts))), 0
    while at < len(size):  # columns of about equal length, MATRIX symbols at a time
        few = slice(at, at + max(1, MATRIX // int(size[at])))
        active = np.searchsorted(-size[few], -np.arange(size[at]), side="left")
        blocks = padded[begin[few][None, :] + np.arange(size[at])[:, None]]
        for k, t in enumerate(tables):
            phrases[k] += np.bincount(owner[few], t.phrases(blocks, active), minlength=len(texts))
        at = few.stop
    for k, t in enumerate(tables):
        bits[:, k] = np.where(n > 0, phrases[k] * np.log2(t.size) / np.maximum(n, 1), np.inf)
    return bits, n


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", train_symbols: int = 40_000, dense: int = 64) -> list[LanguageTable]:
    """Tables from a bounded sample of ``labelled``: for each label, different texts in the order of a hash of the text
    until ``train_symbols`` symbols are together, whatever their alphabet.  Ids play no part; copies count once, and a
    label sends at most ``train_symbols`` texts of twice as many code points to the driver.  At most ``dense`` symbols of a
    language have a column of its table, which is a matter of speed only.  Null labels and empty texts are left out."""
    h = F.pmod(F.xxhash64(text_col, F.lit("train")), F.lit(1 << 30)).alias("h")
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), h).filter("lang IS NOT NULL AND length(text) > 0")
    counts = rows.groupBy("lang", "h").agg(F.max(F.length("text")).alias("chars")).groupBy("lang").agg(F.count("*").alias("docs"), F.sum("chars").alias("chars"))
    counts = counts.orderBy(F.desc("docs"), "lang").collect()  # one row per label
    if not counts:
        return []
    take = {r["lang"]: min(1.0, max(3 * train_symbols / r["chars"], 50 / r["docs"])) for r in counts}  # about three times what is needed
    limit = F.create_map(*[F.lit(x) for lang, part in take.items() for x in (lang, int(part * (1 << 30)) + 1)])
    few = rows.filter(F.col("h") < limit[F.col("lang")]).select("lang", "h", F.substring("text", 1, 2 * train_symbols).alias("text"))
    few = few.groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    sample = few.withColumn("place", place).filter(F.col("place") <= train_symbols).drop("place")
    texts: dict[str, list] = {}
    for r in sorted(sample.collect()):
        texts.setdefault(r["lang"], []).append(r["text"])
    tables, dense = [], max(2, min(dense, CELLS // (2 * train_symbols * len(take))))
    for lang, found in texts.items():
        flat, n = symbols(list(dict.fromkeys(found)))
        if len(flat) and n.any():
            tables.append(LanguageTable(lang, flat[:train_symbols], dense))
    return tables


def identify(docs: DataFrame, tables: list[LanguageTable], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, lang_pred, score, bits``, one row per input row.

    ``lang_pred`` is ``und`` with score 0 and null bits if the text is null or
    has no letters, or nothing was learned.  ``score`` is 1 - best / second
    best entropy (1 with one language); ``bits`` the best entropy per symbol.
    Ties go to the label that sorts first.  An empty table gives no rows.
    """
    tables = sorted(tables, key=lambda t: t.lang)
    bound_batches(docs.sparkSession)
    shared = share(docs.sparkSession, tables)
    text = F.col(text_col).alias("__text")
    head = docs.select(text, id_col)
    out = T.StructType([*head.schema.fields[1:], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared()
        names = np.array([t.lang for t in tables], object)
        for b in batches:
            for texts, *rest in _batches(b.column(0), *b.columns[1:]):
                bits, n = parse(tables, [x or "" for x in texts])
                known = (n > 0) & bool(tables)
                lang, score, best = np.full(len(texts), "und", object), np.zeros(len(texts)), np.full(len(texts), np.nan)
                if tables and len(texts):
                    order = np.sort(bits, axis=1)
                    best = np.where(known, order[:, 0], np.nan)
                    second = order[:, 1] if len(tables) > 1 else np.full(len(texts), np.inf)
                    with np.errstate(invalid="ignore"):
                        score = np.where(known, np.clip(1 - order[:, 0] / second, 0, 1), 0.0)
                    lang[known] = names[bits.argmin(axis=1)][known]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(best, from_pandas=True)], names=out.names)

    return head.mapInArrow(run, out)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is held out; one without an id never is."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tables = train(docs.filter(~held_out()))
    return identify(docs, tables).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits")
