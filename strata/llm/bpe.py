"""BPE encoding by backtracking over longest matches; decoding by an offset table.

A word's longest tokens per position come from one Aho-Corasick pass. Tokens
are laid from the left, longest first; a token may follow another only if BPE
would leave the border between the two unmerged. If none fits, the last token
is taken back and a shorter one tried, and positions found dead are not tried
again, so a word takes time linear in its length. The only sequence in which
all neighbours are compatible is the one the merges make.

Whether BPE leaves a border alone is decided from the pair table: the tokens
that face each other at the border are undone, latest merge first, and at no
time may the facing pair have a merge that comes before the next change.

Decoding copies spans of one byte pool: token ``t`` is the bytes from
``starts[t]`` to ``starts[t + 1]``.

The vocabulary is a tokenizer file (its path is the caller's parameter): BPE
merges over byte-level symbols, an optional suffix on a word's last symbol,
and special tokens that are cut out of the raw text first.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from itertools import chain
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow

#: Stretches between spaces (words among them) and borders whose results a
#: task keeps; longer stretches are not kept.
KEPT, KEPT_LENGTH = 1 << 18, 64
#: Tokens of an output batch (a longer text makes a batch of its own).
BATCH_TOKENS = 1 << 20
#: Added to a word's last symbol, to tell it from the same symbol inside.
_LAST = 0x10000

# The normaliser and the word pattern of the tokenizer files that are understood.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level files."""
    shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    hidden = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
    return [hidden.get(b, chr(b)) for b in range(256)]


def newer_than_python(text: str) -> bool:
    """Whether a character is unknown to this Python's Unicode tables; the
    tokenizers library, with its own, then normalises and splits the text."""
    return any(unicodedata.category(c) == "Cn" for c in set(text))


class _Kept(dict):
    """Up to ``KEPT`` results of ``make``, by key; emptied when full."""

    def __init__(self, make: Callable) -> None:
        self._make = make

    def __missing__(self, key):
        made = self._make(key)
        if len(key) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.clear()
            self[key] = made
        return made


class Vocabulary:
    """Tables of one tokenizer file; ``ValueError`` if its kind is not the one above."""

    def __init__(self, file: bytes) -> None:
        spec = json.loads(file)
        model = spec["model"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
        known = [c["type"] for c in cuts] == ["Split", "ByteLevel"] and cuts[0]["pattern"] == {"Regex": WORDS}
        flags = any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if model["type"] != "BPE" or kinds != NORMALIZERS or not plain or not known or flags or spec["decoder"]:
            raise ValueError("not a byte-level BPE file of the kind this module reads")
        self._read_merges(model)
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self._special, key=len, reverse=True)
        self._specials = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")
        whole = tokenizers.Tokenizer.from_str(file.decode())
        self._library = (whole.normalizer, tokenizers.pre_tokenizers.Split(tokenizers.Regex(WORDS), "removed", invert=True))
        self._letters = {b: s for b, s in enumerate(byte_symbols())}
        self.border = functools.lru_cache(KEPT)(self._border)
        self._kept = _Kept(self._ids)
        strings = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self._special.items()}
        pool = [(strings.get(i, "") + " ").encode() for i in range(max(strings) + 1)]
        self.starts = np.concatenate([[0], np.cumsum([len(p) for p in pool])])
        self.pool = np.frombuffer(b"".join(pool), dtype=np.uint8)

    def _read_merges(self, model: dict) -> None:
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.rank: dict[int, int] = {}  # a token's merge; single symbols come before all merges
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        spelled: dict[int, str] = {}
        for symbol in byte_symbols():
            inside, last = vocab[symbol], vocab[symbol + suffix]
            spelled[inside], self.rank[inside] = symbol, -1
            if last != inside:
                spelled[last], self.rank[last] = chr(ord(symbol) + _LAST), -1
        self._mark_last = bool(suffix)
        for at, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair, token = (vocab[left], vocab[right]), vocab[left + right]
            if token in self.rank or any(p not in self.rank for p in pair):
                raise ValueError(f"merge {at} makes a token twice or uses one that no merge has made yet")
            spelled[token] = spelled[pair[0]] + spelled[pair[1]]
            self.rank[token], self.halves[token], self.merged[pair] = at, pair, token
        # A token whose own text BPE would merge otherwise never comes out.
        own = {t for t, r in self.rank.items() if r < 0}
        for token, (left, right) in self.halves.items():
            if left in own and right in own and self._border(left, right, 2 * self.rank[token]):
                own.add(token)
        by_text = {spelled[t]: t for t in own}
        self.length = {t: len(spelled[t]) for t in own}
        self._backwards = ahocorasick.Automaton()
        for text, token in by_text.items():
            self._backwards.add_word(text[::-1], token)
        self._backwards.make_automaton()
        #: The longest token that is a proper prefix of the token's text, or -1.
        self.shorter = {
            t: next((by_text[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in by_text), -1)
            for text, t in by_text.items()
        }

    def _border(self, left: int, right: int, until: float = float("inf")) -> bool:
        """Whether BPE leaves the border between two tokens unmerged.

        ``until``: twice the rank of the merge that ends the present pair, plus
        one if it is the right token's (of equal merges the leftmost comes first).
        """
        rank = self.rank
        while True:
            pair = self.merged.get((left, right))
            if pair is not None and 2 * rank[pair] < until:
                return False
            if rank[left] > rank[right]:
                until, left = 2 * rank[left], self.halves[left][1]
            elif rank[right] >= 0:
                until, right = 2 * rank[right] + 1, self.halves[right][0]
            else:
                return True

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one word in byte-level symbols."""
        size = len(word)
        if self._mark_last:
            word = word[:-1] + chr(ord(word[-1]) + _LAST)
        # An end in the reversed word is a start here; of one end the longest match
        # comes first, so from back to front it is the one that stays.
        longest = dict([*self._backwards.iter(word[::-1])][::-1])
        length, shorter, border = self.length, self.shorter, self.border
        tokens, at, token, last, dead = [], 0, longest[size - 1], -1, set()
        while True:
            while token >= 0:
                end = at + length[token]
                if end not in dead and (last < 0 or border(last, token)):
                    break
                token = shorter[token]
            else:
                dead.add(at)
                at -= length[last]
                token = shorter[tokens.pop()]
                last = tokens[-1] if tokens else -1
                continue
            tokens.append(token)
            if end == size:
                return tokens
            at, last, token = end, token, longest[size - 1 - end]

    def normalised(self, text: str) -> bytes:
        """UTF-8 of the normalised text (runs of spaces are left: no word holds one)."""
        if text.isascii():
            return text.encode().lower()
        if newer_than_python(text):
            return self._library[0].normalize_str(text).encode()
        # character by character: no special form for a final sigma
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower().encode()

    def split(self, stretch: str) -> list[str]:
        """Words of a normalised stretch of text."""
        if stretch.isalpha():  # letters, all known to this Python
            return [stretch]
        if not stretch.isascii() and newer_than_python(stretch):
            return [w for w, _ in self._library[1].pre_tokenize_str(stretch)]
        return _WORDS.findall(stretch)

    def _ids(self, stretch: bytes) -> bytes:
        text = stretch.decode()
        words = self.split(text)
        if words != [text]:
            return b"".join([self._kept[w.encode()] for w in words])
        plain = text.isascii() and text.isprintable()  # those bytes are shown as they are
        symbols = text if plain else "".join(map(self._letters.__getitem__, stretch))
        return array("i", self.encode_word(symbols)).tobytes()

    def encode(self, text: str) -> bytes:
        """Token ids of a whole text, as native 32-bit integers.

        Words never hold a space, so the text goes stretch by stretch."""
        parts, at = [], 0
        for special in chain(self._specials.finditer(text), [None]):
            piece = text[at : special.start()] if special else text[at:]
            parts += map(self._kept.__getitem__, self.normalised(piece).split())
            if special:
                parts.append(array("i", [self._special[special[0]]]).tobytes())
                at = special.end()
        return b"".join(parts)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the texts of token runs: run ``k`` is
        ``ids[ends[k] : ends[k + 1]]``; tokens are joined by one space."""
        sizes = (self.starts[1:] - self.starts[:-1])[ids]
        places = np.concatenate([[0], np.cumsum(sizes)])
        source = np.repeat(self.starts[:-1][ids] - places[:-1], sizes) + np.arange(places[-1])
        data = self.pool[source]
        last = ends[1:][ends[1:] > ends[:-1]]  # no space after a run's last token
        data = np.delete(data, places[last] - 1)
        return data, places[ends] - np.concatenate([[0], np.cumsum(ends[1:] > ends[:-1])])


@functools.lru_cache(2)
def vocabulary(file: bytes) -> Vocabulary:
    """Tables of a file, made once per worker process."""
    return Vocabulary(file)


def read_file(path: str) -> bytes:
    """A tokenizer file's bytes, read by the driver; its size is the vocabulary's."""
    return Path(path).read_bytes()


def _slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` items together (a longer row alone)."""
    total = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + most, side="right")))
        yield at, end
        at = end


def _map(df: DataFrame, file: bytes, run: Callable, schema: str) -> DataFrame:
    """``run(vocabulary, batch)`` over ``df``; the file goes out as one broadcast of its own size."""
    shared = df.sparkSession.sparkContext.broadcast(file)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = vocabulary(shared.value)
        for batch in found:
            yield from run(tables, batch)

    return map_arrow(df, batches, schema)


def _encode(tables: Vocabulary, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    parts, ends, at = [], [0], 0
    for k, text in enumerate(batch.column(1)):
        parts.append(tables.encode(text.as_py() or ""))
        ends.append(ends[-1] + len(parts[-1]) // 4)
        if ends[-1] >= BATCH_TOKENS or k + 1 == batch.num_rows:
            ids = pa.array(np.frombuffer(b"".join(parts), dtype=np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, k + 1 - at), lists], ["doc_id", "ids"])
            parts, ends, at = [], [0], k + 1


def _decode(tables: Vocabulary, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    lengths = batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    for start, end in _slices(lengths, BATCH_TOKENS):
        part = batch.slice(start, end - start)
        lists = part.column(1)
        ends = np.concatenate([[0], np.cumsum(lengths[start:end])])
        data, offsets = tables.decode(lists.flatten().to_numpy(), ends)
        kind = pa.large_string() if len(data) >= 1 << 31 else pa.string()
        places = offsets.astype(np.int64 if kind == pa.large_string() else np.int32)
        buffers = [None, pa.py_buffer(places.tobytes()), pa.py_buffer(data.tobytes())]
        texts = pa.Array.from_buffers(kind, end - start, buffers)
        yield pa.RecordBatch.from_arrays([part.column(0), lists, texts], ["doc_id", "ids", "text"])


def encode_documents(docs: DataFrame, file: bytes) -> DataFrame:
    """``(doc_id, ids)``: the whole text's token ids, one row per row of ``docs``.

    Null and empty texts have no tokens. Null ids and repeated rows are kept,
    other columns are ignored, an empty table gives no rows. A text is held
    whole in its task; words of any length take linear time.
    """
    return _map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), file, _encode, "doc_id long, ids array<int>")


def decode_documents(coded: DataFrame, file: bytes) -> DataFrame:
    """``(doc_id, ids, text)``: the text of each row's ids, special tokens included.

    The files read here name no decoder, so tokens are joined by one space and
    keep their word ends. No ids (or null) give the empty text; an id outside
    the vocabulary is an ``IndexError``.
    """
    return _map(coded.select("doc_id", "ids"), file, _decode, "doc_id long, ids array<int>, text string")


def digests(coded: DataFrame) -> DataFrame:
    """``coded`` of :func:`decode_documents` as counts and digests."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
