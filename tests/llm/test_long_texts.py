"""Texts of several million code points among short ones, for the operators that run Python."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from helpers import frame, prose
from tidemark.llm import bpe, language_id, ngram_join, secrets

LONG = 3_000_000


@pytest.fixture(scope="module")
def rows():
    words = prose(60_000, 11)
    long = (words + "\n") * (LONG // len(words) + 1)
    other = "".join(chr(0x4E00 + (i * i) % 997) for i in range(4000)) * 400
    return [(1, long, "en", "a", 1), (2, long + " one more word", "en", "a", 1), (3, other, "zh", "b", 1), (4, prose(50, 2), "en", "a", 1), (5, other[:900], "zh", "b", 1), (6, long[:-300] + " token=abcdefgh12", "en", "c", 1)]


def test_bpe(spark, rows):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    some = [rows[i] for i in (0, 3, 4)]
    for r in bpe.bpe_encode(frame(spark, some), path, public_tokenizers.PATTERN).collect():
        text = next(t for d, t, *_ in some if d == r["doc_id"])
        want = np.array(library.encode_ordinary(text), "<u4").tobytes()
        assert hashlib.sha256(r["ids"]).digest() == hashlib.sha256(want).digest() and bytes(r["decoded"]) == text.encode()


def test_language(spark, rows):
    got = language_id.identify(frame(spark, rows), language_id.train(frame(spark, rows))).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {1: "en", 2: "en", 3: "zh", 4: "en", 5: "zh", 6: "en"}


def test_secrets(spark, rows):
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["base"]] for r in secrets.scan_secrets(frame(spark, rows)).select("doc_id", "base").collect()}
    text = rows[5][1]
    assert got == {1: [], 2: [], 3: [], 4: [], 5: [], 6: [("assign", text.index("token="), len(text))]}


def test_near_duplicates(spark, rows):
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.ngram_join(frame(spark, rows)).collect()}
    assert got[1] == (1, 2) and got[2] == (1, 2) and got[6] == (1, 2) and got[3][0] == 3 and got[4] == (4, 0) and got[5] == (5, 0)
