from __future__ import annotations

import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import bpe
from strata.llm.common import table
from strata.llm.queries import op13_bpe

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def file():
    return bpe.read_file(PATH)


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


def ids_of(file, text):
    return np.frombuffer(bpe.vocabulary(file).encode(text), dtype=np.int32).tolist()


def plain_merges(tables, word):
    """The merges one at a time, earliest first, of equal ones the leftmost."""
    spelled = {}
    for token, rank in tables.rank.items():
        if rank < 0:
            spelled[token] = token
    tokens = list(word)
    while True:
        ranked = [(tables.rank[tables.merged[p]], k) for k, p in enumerate(zip(tokens, tokens[1:], strict=False)) if p in tables.merged]
        if not ranked:
            return tokens
        _, k = min(ranked)
        tokens[k : k + 2] = [tables.merged[tuple(tokens[k : k + 2])]]


pieces = st.one_of(
    st.text(max_size=12),
    st.sampled_from(["the ", "aaaa", "nation", "'s", "'LL", "<|endoftext|>", "</w>", "Σς", "é", "é", "\x1c", " ", "1234", "日本", "😀", "\U0001e6c0"]),
    st.text(alphabet="aeinorst", max_size=40),
)


@settings(max_examples=600, deadline=None)
@given(st.lists(pieces, max_size=8).map("".join))
def test_encoding_equals_the_library(file, library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids_of(file, text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abeinorst", min_size=1, max_size=60))
def test_backtracking_equals_merging(file, word):
    tables = bpe.vocabulary(file)
    vocab = json.loads(file)["model"]["vocab"]
    symbols = [vocab[c] for c in word[:-1]] + [vocab[word[-1] + "</w>"]]
    assert tables.encode_word(word) == plain_merges(tables, symbols)


def test_long_words_and_every_block_of_characters(file, library):
    for text in ("a" * 60_000, "ab" * 30_000, "!" * 20_000, "ha" * 9_999 + "x"):
        assert ids_of(file, text) == library.encode(text, add_special_tokens=False).ids
    for start in range(0, 0x30000, 256):
        text = "".join("a" + chr(c) for c in range(start, start + 256) if not 0xD800 <= c < 0xE000)
        assert ids_of(file, text) == library.encode(text, add_special_tokens=False).ids


def test_query_equals_the_library(spark, library):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = {}
    for r in table(spark, SF, "documents").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op13_bpe(spark, SF).collect()}
    assert got == want


def test_edges(spark, file, library, edge_docs, no_docs):
    coded = bpe.encode_documents(edge_docs, file)
    rows = bpe.decode_documents(coded, file).collect()
    want = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in edge_docs.collect()]
    assert sorted(((r.doc_id, r.ids) for r in rows), key=str) == sorted(want, key=str)
    assert all(r.text == library.decode(r.ids, skip_special_tokens=False) for r in rows)
    assert bpe.encode_documents(no_docs, file).count() == 0
    missing = spark.createDataFrame([(1, None), (2, []), (3, [49407, 320])], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decode_documents(missing, file).orderBy("doc_id").collect()] == ["", "", "<|endoftext|> a</w>"]


def test_other_kinds_of_files_are_refused():
    other = json.loads(bpe.read_file(PATH))
    other["model"]["byte_fallback"] = True
    with pytest.raises(ValueError, match="kind"):
        bpe.Vocabulary(json.dumps(other).encode())
    with pytest.raises(ValueError):
        bpe.Vocabulary(bpe.read_file(public_tokenizers.path("byte_bpe_50k.json")))
