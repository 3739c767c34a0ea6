"""Secret scans: fixed patterns, and a randomness test battery with length-aware false-discovery control.

Base spans come from three patterns.  The battery adds spans: every run of 16 or
more token characters gets an inferred encoding (hex, base32, base62, base64,
base64url), and three statistics that are standard normal for a uniformly random
string over that alphabet: chi-squared uniformity, the runs test over character
classes and lag-1 serial correlation.  They are small for random strings and
grow with length for structured ones.

The null hypothesis is "structured".  For each form of structured token (joined
words, CamelCase, snake_case, paths, word with number, repeated blocks) and each
length, the median and lower spread of each statistic are measured on tokens put together
from the corpus's own words, drawn as often as they occur and each alike: words
are counted in all whole texts, outside candidates, while these are scanned, and a weighted sample of bounded size
(priorities by a hash, so reruns agree) goes to the driver.  A form's p-value combines its
three tests by Fisher's method, and a candidate's is the largest over the forms
of its encoding.  Short tokens can't reject the null, as structured ones of that
length look alike.  Benjamini-Hochberg then sets one threshold per length band,
over all candidates of the corpus, from a histogram of fixed size.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from .bpe import _batches
from .common import bound_batches, discard, materialize, share, table

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of [0-9a-f]+ is maximal, so this finds those of 24 and more
#: Candidates of the battery: maximal runs of token characters; '=' counts as trailing padding only, so a run may follow or precede one.
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
LEN_GRID = (16, 20, 24, 32, 48, 64, 96, 128)
BANDS = (20, 24, 32, 48, 80)
#: Bins of the histogram of p-values: so many to a factor of ten, from 1 down to 1e-20; a bin counts at its largest p-value.
BINS_PER_DECADE, DECADES = 50, 20

_LOWER, _UPPER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(128, _OTHER, np.int8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = _LOWER, _UPPER, _DIGIT
_RANK = np.zeros(128, np.float64)
for _i, _c in enumerate("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/-_="):
    _RANK[ord(_c)] = _i

#: Words of the null's vocabulary, in lower-cased text.
WORD = re.compile(r"[a-z]{2,12}")

_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_RUN = pa.struct([("encoding", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("tests", pa.list_(pa.float64()))])
_JUDGED = pa.struct([("encoding", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("band", pa.int32()), ("bin", pa.int32())])
_COUNT = pa.struct([("word", pa.string()), ("n", pa.int64())])


def encoding(token: str) -> tuple[str, int]:
    """Name and alphabet size of the smallest usual encoding that holds the token; '' if none carries keys (digits only)."""
    body = token.rstrip("=")
    s = set(body)
    if s <= set("0123456789-/_+"):
        return "", 10
    if s - {"-"} <= set("0123456789abcdef") or s - {"-"} <= set("0123456789ABCDEF"):
        return "hex", 16
    if s <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"):
        return "base32", 32
    if "/" in s or "+" in s:
        return "base64", 64
    if "-" in s or "_" in s:
        return "base64url", 64
    if s <= set("abcdefghijklmnopqrstuvwxyz0123456789") or s <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"):
        return "base36", 36
    return "base62", 62


_SIZES = {"hex": {_LOWER: 6, _UPPER: 6, _DIGIT: 10}, "base32": {_UPPER: 26, _DIGIT: 6}, "base36": {_LOWER: 26, _DIGIT: 10}}
_SIZES_64 = {_LOWER: 26, _UPPER: 26, _DIGIT: 10, _OTHER: 2}


def battery(token: str, name: str, k: int) -> tuple[float, float, float]:
    """Chi-squared excess, runs and serial correlation, each near 0 for a random string and larger the more structure."""
    body = token.rstrip("=").lower() if name == "base36" else token.rstrip("=")
    x = np.frombuffer((body.replace("-", "") if name == "hex" else body).encode(), np.uint8)
    n = len(x)
    if n < 8:
        return math.inf, math.inf, math.inf
    c = np.bincount(x, minlength=128).astype(float)
    chi = k / n * float((c * c).sum()) - n
    spread = 2 / (9 * (k - 1)) * max(1 - 1 / n, 0.1)
    z_chi = ((chi / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread)  # the cube root is nearly normal, the sum itself is skewed
    cls = _CLASS[x]
    sizes = _SIZES.get(name, _SIZES_64)
    shares = [v / k for v in sizes.values()]
    if name == "hex":
        shares = [10 / 16, 6 / 16]
    change = 1 - sum(s * s for s in shares)
    z_runs = (float((cls[1:] != cls[:-1]).sum()) - (n - 1) * change) / math.sqrt((n - 1) * change * (1 - change))
    r = _RANK[x]
    sd = r.std()
    z_serial = math.sqrt(n) * (float(np.mean((r[1:] - r.mean()) * (r[:-1] - r.mean()))) / sd**2 if sd > 0 else 1.0) + 1 / math.sqrt(n)
    return z_chi, abs(z_runs), abs(z_serial)


def _forms(pick: Callable[[], str], rng: np.random.Generator, n: int) -> dict[str, str]:
    number = lambda: str(rng.integers(10 ** rng.integers(1, 5)))

    def joined(part, sep: str) -> str:
        out = part()
        while len(out) < n:
            out += sep + part()
        return out[:n]

    block = f"{rng.integers(256):02x}" + "0" * int(rng.integers(1, 5))
    return {
        "words": joined(pick, ""),
        "camel": joined(lambda: pick().capitalize(), ""),
        "snake": joined(lambda: pick() if rng.random() < 0.8 else number(), "_"),
        "kebab": joined(lambda: pick() if rng.random() < 0.8 else number(), "-"),
        "path": joined(lambda: pick().capitalize() if rng.random() < 0.3 else pick(), "/"),
        "numbered": joined(lambda: pick() + number(), ""),
        "camel_numbered": joined(lambda: pick().capitalize() + (number() if rng.random() < 0.2 else ""), ""),
        "upper": joined(lambda: pick().upper() + (number() if rng.random() < 0.3 else ""), ""),
        "blocks": (block * n)[:n],
    }


def _low_side(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Median, and the spread below it from the lowest twentieth: only small values speak for randomness, and words of many repeats skew the other side."""
    middle = np.median(v, axis=0)
    return middle, np.maximum((middle - np.quantile(v, 0.05, axis=0)) / 1.645, 0.25)


class Null:
    """Median and spread of the statistics by form and length, from words and their weights."""

    def __init__(self, words: dict[str, tuple[float, float]], draws: int = 250, seed: int = 7):
        """``words``: for each, the occurrences and the different words it stands for.  Forms are made of either, common words and rare ones."""
        names = sorted(words) or ["the", "value"]
        weight = np.cumsum([words.get(w, (1.0, 1.0)) for w in names], axis=0)
        rng = np.random.default_rng(seed)
        picks = [lambda w=w: names[int(np.searchsorted(w, rng.random() * w[-1], side="right"))] for w in weight.T]
        seen: dict[str, dict[str, list[list[tuple[float, ...]]]]] = {}
        for i, n in enumerate(LEN_GRID):
            for _ in range(draws):
                for j, pick in enumerate(picks):
                    for form, token in _forms(pick, rng, n).items():
                        name, k = encoding(token)
                        if name:
                            seen.setdefault(name, {}).setdefault(f"{form}{j}", [[] for _ in LEN_GRID])[i].append(battery(token, name, k))
        self.fits: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for name, forms in seen.items():
            for per in forms.values():
                ok = [(math.log(n), *_low_side(np.array(v))) for n, v in zip(LEN_GRID, per, strict=True) if len(v) >= 20]
                if ok:
                    self.fits.setdefault(name, []).append(tuple(np.array(c) for c in zip(*ok, strict=True)))

    def p_value(self, u: tuple[float, ...], name: str, n: int) -> float:
        """Against the forms that give tokens of this encoding; against all where none does."""
        at, worst = math.log(n), 1e-20
        for x, m, d in self.fits.get(name) or [x for f in self.fits.values() for x in f]:
            y = 0.0  # Fisher: minus the sum of the logarithms
            for t in range(3):
                z = (u[t] - np.interp(at, x, m[:, t])) / np.interp(at, x, d[:, t])
                y -= math.log(max(1e-12, 0.5 * math.erfc(-z / math.sqrt(2))))
            worst = max(worst, math.exp(-y) * (1 + y + y * y / 2))
        return worst


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def _mask(spans: list[tuple[int, int, str]], start: int, end: int) -> bool:
    return any(a < end and start < b for a, b, _ in spans)


def run_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[str, int, int, tuple[float, ...]]]:
    """Candidates clear of the base spans: encoding, start, end and the battery's three statistics."""
    out = []
    for m in RUN.finditer(text):
        token, n = m[0], m.end() - m.start()
        if n >= 16 and token.isalpha() and (token.islower() or token[1:].islower()):
            continue  # a word of one case: no encoding of keys
        name, k = encoding(token)
        if name and not _mask(base, m.start(), m.end()):
            out.append((name, m.start(), m.end(), battery(token, name, k)))
    return out


def plain(text: str, base: list[tuple[int, int, str]], runs: list[dict]) -> str:
    """The text without base spans and candidates, whose random letters are no vocabulary."""
    if not base and not runs:
        return text
    out, at = [], 0
    for s, e in sorted([(s, e) for s, e, _ in base] + [(r["start"], r["end"]) for r in runs]):
        out.append(text[at : max(at, s)])
        at = max(at, e)
    return " ".join([*out, text[at:]])


def judged(run: dict, null: Null) -> dict:
    """A candidate with its length band and the bin of its p-value."""
    n = run["end"] - run["start"]
    p = null.p_value(tuple(run["tests"]), run["encoding"], n)
    return {k: run[k] for k in ("encoding", "start", "end")} | {"band": sum(n >= b for b in BANDS), "bin": min(DECADES * BINS_PER_DECADE, int(-math.log10(p) * BINS_PER_DECADE))}


def vocabulary(counts: DataFrame, words: int) -> dict[str, tuple[float, float]]:
    """A sample of ``words`` words of ``counts(word, n)`` with weights that stand for all: those of lowest -ln(u) / n, u by a hash of the word.

    A word is taken with probability 1 - exp(-n * t), t the priority of the first word left out, and stands for n occurrences and one word over that."""
    u = (F.pmod(F.xxhash64("word", F.lit("null")), F.lit(1 << 40)) + 0.5) / F.lit(float(1 << 40))
    known = counts.withColumn("priority", -F.log(u) / F.col("n"))
    total, part, ranked = known.count(), 1.2, []
    while len(ranked) <= words and len(ranked) < total:  # a cut below which about as many lie, so that no task sends more than its share of them
        few = known
        if part * (words + 1) < total:
            cut = known.agg(F.percentile_approx("priority", part * (words + 1) / total, 100_000)).first()[0]
            few = known.filter(F.col("priority") <= cut)
        ranked, part = few.orderBy("priority", "word").limit(words + 1).collect(), 4 * part
    t = ranked[words]["priority"] if len(ranked) > words else math.inf
    taken = {r["word"]: (r["n"], -math.expm1(-r["n"] * t)) for r in ranked[:words]}
    return {w: (n / p, 1 / p) for w, (n, p) in taken.items()}


def thresholds(histogram: list[tuple[int, int, int]], q: float, per_decade: int = 10) -> dict[int, int]:
    """Benjamini-Hochberg by band from ``(band, bin, count)``: the lowest bin that may be reported.  A bin counts at its largest p-value."""
    out: dict[int, int] = {}
    for band in {b for b, _, _ in histogram}:
        counts = {i: c for b, i, c in histogram if b == band}
        total, above = sum(counts.values()), 0
        for i in range(DECADES * per_decade, 0, -1):
            above += counts.get(i, 0)
            if above and 10 ** (-i / per_decade) * total / above <= q:
                out[band] = i
    return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = 0.01, null_words: int = 20_000) -> DataFrame:
    """``<id_col>, base, random``: arrays of spans in code points, end exclusive; ``random`` holds spans clear of all base ones.

    ``q`` bounds the expected share of structured tokens among the added spans
    of a length band.  The null draws from ``null_words`` words, a weighted
    sample of the counts over all texts.  Null text is empty; one row per
    input row, repeated rows too; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    head = rows.select(id_col).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for texts, keys in _batches(b.column(1), b.column(0)):
                bases, runs, words = [], [], Counter()
                for t in texts:
                    base = base_spans(t or "")
                    bases.append([{"kind": k, "start": s, "end": e} for s, e, k in base])
                    runs.append([dict(zip(("encoding", "start", "end", "tests"), x, strict=True)) for x in run_spans(t or "", base)])
                    words.update(WORD.findall(plain(t or "", base, runs[-1]).lower()))
                counted = [[{"word": w, "n": n} for w, n in words.items()], *[None] * (len(texts) - 1)]  # of the whole batch, in its first row
                columns = [keys, pa.array(bases, pa.list_(_SPAN)), pa.array(runs, pa.list_(_RUN)), pa.array(counted[: len(texts)], pa.list_(_COUNT))]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "base", "runs", "words"])

    def schema(**columns: pa.DataType) -> T.StructType:
        return T.StructType([*head.fields, *(T.StructField(k, T.ArrayType(from_arrow_type(v))) for k, v in columns.items())])

    found = materialize(rows.mapInArrow(scan, schema(base=_SPAN, runs=_RUN, words=_COUNT)), "secrets-found")
    counts = found.select(F.explode("words").alias("w")).groupBy("w.word").agg(F.sum("w.n").alias("n"))
    counts = materialize(counts, "secrets-words")
    shared = share(spark, Null(vocabulary(counts, null_words)))
    discard(counts)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        null = shared()
        for b in batches:
            runs = [[judged(r, null) for r in found] for found in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(runs, pa.list_(_JUDGED))], names=[id_col, "base", "runs"])

    scanned = materialize(found.drop("words").mapInArrow(judge, schema(base=_SPAN, runs=_JUDGED)), "secrets")
    discard(found)
    histogram = scanned.select(F.explode("runs").alias("r")).groupBy("r.band", "r.bin").count().collect()  # at most bands x bins rows
    least = thresholds([tuple(r) for r in histogram], q, BINS_PER_DECADE)
    bound = F.create_map(*[F.lit(x) for kv in least.items() for x in kv]) if least else None
    keep = F.filter("runs", lambda r: r["bin"] >= F.coalesce(bound[r["band"]], F.lit(DECADES * BINS_PER_DECADE + 1))) if least else F.filter("runs", lambda r: F.lit(False))
    span = lambda r: F.struct(F.lit("random").alias("kind"), r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"))
    return scanned.select(id_col, "base", F.transform(keep, span).alias("random"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    order = F.array(*map(F.lit, KINDS))
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("o"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.array_join(F.transform(F.sort_array(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    plain = F.transform("random", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    base, spans = joined(F.col("base")), joined(F.concat("base", plain))
    n_random = F.size("random").cast("long").alias("n_random")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"), n_random)
