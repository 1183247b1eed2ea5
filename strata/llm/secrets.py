"""Secret scan: keyword automaton, anchored expressions near hits, checksums.

One Aho-Corasick pass over the text with A-Z folded finds the keywords; the
expression of a kind is tried only at a keyword's position, as a match must
start there. Bare hexadecimal runs have no keyword: a byte-class projection
of the text finds the documents that hold a long run at all, and only those
are searched. Tokens with an embedded checksum are added when it is right.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow

#: Base kinds in the order used for ties, then the checksummed ones.
KINDS = ("assign", "access", "hex", "github", "npm")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
_HEX_CLASS = bytes(48 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def keyword_automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def checksum_matches(body: str, check: str) -> bool:
    """The last six characters are the body's CRC-32 in base 62."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = _BASE62[rest] + digits
    return digits == check


def _accept(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[2]) >= MIN_VALUE
    if kind == "access":
        return len(match[0]) >= MIN_ACCESS
    return checksum_matches(match[1], match[2])


_ANCHORED = {"assign": ASSIGN, "access": ACCESS, "github": GITHUB, "npm": NPM}


def scan(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of every span, sorted; offsets in code points.

    A failing match still uses up its characters, as in a left-to-right
    search for the whole expression.
    """
    raw = text.encode()
    spans, used = [], dict.fromkeys(_ANCHORED, 0)
    for last, (kind, size) in automaton.iter(raw.lower().decode()):  # folds A-Z only: offsets stay
        start = last - size + 1
        if start < used[kind] or not (match := _ANCHORED[kind].match(text, start)):
            continue
        used[kind] = match.end()
        if _accept(kind, match):
            spans.append((start, KINDS.index(kind), match.end()))
    if b"0" * MIN_HEX in raw.translate(_HEX_CLASS):
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return sorted(spans)


def _text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``.

    ``n_assign``, ``n_access``, ``n_hex``, ``n_checksum``: spans per kind;
    ``base_sha256``: digest of the base spans; ``spans``: all of them as
    ``kind:start:end``. Null and empty texts have no span (digest of the empty
    string). Null ids and repeated rows are kept; other columns are ignored;
    an empty table gives no rows. Texts are scanned whole, one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = keyword_automaton()
        for batch in batches:
            rows = []
            for value in batch.column(1):
                spans = scan(value.as_py() or "", automaton)
                base = [s for s in spans if s[1] < 3]
                counts = [sum(s[1] == k for s in base) for k in range(3)]
                digest = hashlib.sha256(_text(base).encode()).hexdigest()
                rows.append((*counts, len(spans) - len(base), digest, _text(spans)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_checksum", "base_sha256", "spans"],
            )

    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        run,
        "doc_id long, n_assign long, n_access long, n_hex long, n_checksum long, base_sha256 string, spans string",
    )
