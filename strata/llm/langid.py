"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built of labelled text. A text is
parsed against it into phrases, each the longest match with any substring of
the labelled text (the cross-parsing of Ziv and Merhav); the language that
needs the fewest normalised phrases wins. A phrase costs a pointer into the
labelled text, so counts are normalised by the logarithm of its length.

The automata are deterministic: a phrase ends where no transition exists and
the next begins with that symbol. Their transitions, at most three a symbol
of labelled text whatever the script, become arrays (a dense table of the
language's common letters and a hash table of the others), and a batch of texts advances through a language together, one symbol of every text
a step; the ends of texts much longer than the others are walked alone, from
the state they have reached.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, remainder_of_id

#: Bounds of the fit: labelled rows that are drawn per language, characters
#: taken of a drawn row, and characters per language given to an automaton
#: (its hash table takes 3 MB at most). Every language and letter is learned.
SAMPLE_ROWS = 60
SAMPLE_ROW_CHARS = 2_000
TRAIN_CHARS = 24_000
#: Characters of the texts that advance together.
TOGETHER_CHARS = 1 << 22
#: Cells (4 bytes) of all languages' dense tables, and columns at most. They
#: decide how fast a letter is looked up, never what is found.
DENSE_CELLS, DENSE_COLUMNS = 1 << 25, 200
#: Fewer texts than this are walked one by one, which is quicker then.
FEW = 64
UNKNOWN = "und"
_SPACE = 0


class Automaton:
    """Suffix automaton over small integers."""

    def __init__(self, symbols):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        last = 0
        for symbol in symbols:
            last = self._extend(last, symbol)

    def _state(self, size: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.size.append(size)
        self.link.append(link)
        return len(self.next) - 1

    def _extend(self, last: int, symbol: int) -> int:
        new = self._state(self.size[last] + 1, 0, {})
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at < 0:
            return new
        seen = self.next[at][symbol]
        if self.size[seen] != self.size[at] + 1:
            copy = self._state(self.size[at] + 1, self.link[seen], dict(self.next[seen]))
            while at >= 0 and self.next[at].get(symbol) == seen:
                self.next[at][symbol] = copy
                at = self.link[at]
            self.link[seen] = copy
            seen = copy
        self.link[new] = seen
        return new


def normalise(text: str) -> str:
    """Lower-cased letters, every run of other characters one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class Transitions:
    """Transitions of an automaton as arrays.

    ``dense[state, column]`` is the next state shifted left by one, its lowest
    bit set if a new phrase begins; columns are the language's commonest
    symbols, then one for all symbols it does not have. Its other symbols are
    in a hash table with linear probing. ``fresh`` is the state after the first
    symbol of a phrase (the initial one, 0, if the language lacks the symbol).
    """

    _FREE, _FACTOR = np.uint64(2**64 - 1), np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, automaton: Automaton, width: int, columns: int):
        self.width = width
        self.fresh = np.zeros(width, dtype=np.int32)
        for symbol, to in automaton.next[0].items():
            self.fresh[symbol] = to
        edges = [(state, symbol, to) for state, out in enumerate(automaton.next) if state for symbol, to in out.items()]
        states, symbols, targets = np.array(edges, dtype=np.int64).reshape(-1, 3).T
        uses = np.bincount(symbols, minlength=width)
        self.common = np.lexsort((np.arange(width), -uses))[:columns]
        self.common = self.common[self.fresh[self.common] > 0]
        self.none, self.rare = len(self.common), len(self.common) + 1
        self.column = np.where(self.fresh > 0, self.rare, self.none).astype(np.int32)
        self.column[self.common] = np.arange(len(self.common))
        self.row = len(self.common) + 2
        dense = np.ones((len(automaton.next), self.row), dtype=np.int32)
        dense[:, : self.none] = (self.fresh[self.common] << 1) | 1
        kept = self.column[symbols] < self.none
        dense[states[kept], self.column[symbols[kept]]] = targets[kept] << 1
        self.dense = dense.ravel()
        self.has_rare = bool((self.column == self.rare).any())
        self._hash((states * width + symbols)[~kept].astype(np.uint64), targets[~kept])
        self._walked: dict[int, int] = {}

    def _hash(self, wanted: np.ndarray, targets: np.ndarray) -> None:
        bits = max(4, (2 * len(wanted)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, self._FREE, dtype=np.uint64)
        self.targets = np.zeros(1 << bits, dtype=np.int32)
        at = self._slot(wanted)
        while len(wanted):  # each round one key takes a free slot, the others there go on to the next
            _, first = np.unique(at, return_index=True)
            first = first[self.keys[at[first]] == self._FREE]
            self.keys[at[first]], self.targets[at[first]] = wanted[first], targets[first]
            left = np.ones(len(wanted), dtype=bool)
            left[first] = False
            wanted, targets, at = wanted[left], targets[left], (at[left] + 1) & self.mask

    def __getstate__(self):
        return self.__dict__ | {"_walked": {}}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self._FACTOR) >> self.shift).astype(np.int64)

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Next states shifted left by one, the lowest bit set where a new
        phrase begins."""
        columns = self.column[symbols]
        moves = self.dense[states * self.row + columns]
        if self.has_rare:
            rare = np.flatnonzero(columns == self.rare)
            if len(rare):
                moves[rare] = self._step_rare(states[rare], symbols[rare])
        return moves

    def _step_rare(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        keys = (states.astype(np.int64) * self.width + symbols).view(np.uint64)
        at = self._slot(keys)
        held = self.keys[at]
        hit = held == keys
        look = np.flatnonzero(~hit & (held != self._FREE))
        while len(look):
            at[look] = (at[look] + 1) & self.mask
            held = self.keys[at[look]]
            same = held == keys[look]
            hit[look[same]] = True
            look = look[~same & (held != self._FREE)]
        return np.where(hit, self.targets[at] << 1, (self.fresh[symbols] << 1) | 1)

    def walk(self, state: int, symbols: list[int]) -> int:
        """Phrases that begin in ``symbols``, from a state on."""
        if not self._walked:
            used = self.keys != self._FREE
            found = dict(zip(self.keys[used].tolist(), self.targets[used].tolist(), strict=True))
            at = np.flatnonzero(self.dense & 1 == 0)
            keys = at // self.row * self.width + self.common[at % self.row]
            found.update(zip(keys.tolist(), (self.dense[at] >> 1).tolist(), strict=True))
            self._walked = found
        follow, fresh, width, begun = self._walked.get, self.fresh.tolist(), self.width, 0
        for symbol in symbols:
            to = follow(state * width + symbol)
            if to is None:
                begun += 1
                to = fresh[symbol]
            state = to
        return begun


class Model:
    """The languages' automata over one alphabet, all letters of the samples.

    ``lookup`` gives a code point's symbol: 0 space or no letter, 1 .. letters,
    the last for letters of no sample, which match nothing. A phrase costs a
    pointer into the language's text, but no less than naming a letter, so a
    language of a few words does not win by short pointers.
    """

    def __init__(self, samples: dict[str, list[str]], chars: int = TRAIN_CHARS):
        self.languages = sorted(samples)
        joined = {lang: " ".join(map(normalise, samples[lang]))[:chars] for lang in self.languages}
        letters = sorted(set().union(*joined.values()) - {" "})
        self.unknown = len(letters) + 1
        alpha = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        self.lookup = np.where(alpha, self.unknown, _SPACE).astype(np.int32)
        for symbol, letter in enumerate(letters, 1):
            self.lookup[ord(letter)] = symbol
        width = self.unknown + 1
        self.cost = np.log2([max(len(joined[lang]), len(letters)) + 2.0 for lang in self.languages])
        states = 2 * sum(map(len, joined.values())) + len(joined)  # at most
        columns = min(DENSE_COLUMNS, DENSE_CELLS // max(1, states))
        self.tables = [
            Transitions(Automaton(self.lookup[self._codes(joined[lang])].tolist()), width, columns) for lang in self.languages
        ]

    @staticmethod
    def _codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of a whole text, runs of spaces collapsed and ends trimmed."""
        found = self.lookup[self._codes(text.lower())]
        keep = found != _SPACE
        keep[1:] |= keep[:-1].copy()
        found = found[keep]
        return found[:-1] if len(found) and found[-1] == _SPACE else found

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        counts = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        order = sorted((k for k, t in enumerate(texts) if len(t)), key=lambda k: -len(texts[k]))
        if not order:
            return counts
        sizes = np.array([len(texts[k]) for k in order])
        flat = np.concatenate([texts[k] for k in order])
        starts = np.cumsum(sizes) - sizes
        steps = int(sizes[FEW - 1]) if len(order) >= FEW else 0
        alive = len(order) - np.searchsorted(sizes[::-1], np.arange(steps + 1), side="right")
        columns = [flat[starts[:n] + step] for step, n in enumerate(alive[:-1].tolist())]
        ends = [texts[k][steps:].tolist() for k in order[: alive[-1]]]
        for number, table in enumerate(self.tables):
            states = np.zeros(len(order), dtype=np.int32)
            found = np.zeros(len(order), dtype=np.int64)
            for symbols in columns:
                moves, n = table.step(states[: len(symbols)], symbols), len(symbols)
                found[:n] += moves & 1
                states[:n] = moves >> 1
            for k, end in enumerate(ends):
                found[k] += table.walk(int(states[k]), end)
            counts[order, number] = found
        return counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text.

        The score is one minus half the winner's normalised phrases over the
        runner-up's: 0.5 is a tie. Without letters, or with
        no language learned, the answer is ``und`` with score 0.
        """
        names, scores, begin, chars = [], [], 0, 0
        for end, text in enumerate(texts, 1):  # texts advance together up to so many characters
            chars += len(text or "")
            if chars >= TOGETHER_CHARS or end == len(texts):
                for name, score in self._answers(texts[begin:end]):
                    names.append(name)
                    scores.append(score)
                begin, chars = end, 0
        return names, scores

    def _answers(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        coded = [self.symbols(t) if t else np.zeros(0, dtype=np.int32) for t in texts]
        counts = self.phrases(coded) * self.cost
        for symbols, row in zip(coded, counts, strict=True):
            if not len(symbols) or not len(row):
                yield UNKNOWN, 0.0
                continue
            order = np.argsort(row, kind="stable")
            second = row[order[1]] if len(row) > 1 else row[order[0]]
            yield self.languages[order[0]], float(1 - 0.5 * row[order[0]] / second)


def training_sample(docs: DataFrame, *, rows: int = SAMPLE_ROWS, row_chars: int = SAMPLE_ROW_CHARS) -> dict[str, list[str]]:
    """Labelled texts of every language: a bounded draw by a hash of id and text.

    Counts of distinct texts per language set the rate at which they enter, so
    about four times ``rows`` per language are ranked, copies once, and no
    language's rows meet in one task.
    A text longer than ``row_chars`` gives a piece of that length from a place
    that the hash chooses. Only rows without a language, without text or with
    an empty one are left out.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "lang", "text", F.xxhash64("doc_id", "text", F.lit("langid")).alias("hash")
    )
    draw = F.pmod("hash", F.lit(1 << 30)) / F.lit(float(1 << 30))
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n"))
    # one row a language, far less than the model, which goes everywhere too
    few = labelled.join(F.broadcast(counts), "lang").withColumn("draw", draw).filter(F.col("draw") * F.col("n") < 4 * rows)
    start = F.pmod(F.shiftrightunsigned("hash", 30), F.greatest(F.length("text") - row_chars, F.lit(0)) + 1) + 1
    piece = F.substr("text", start.cast("int"), F.lit(row_chars))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "hash"))
    texts = few.select("lang", "hash", "draw", piece.alias("piece")).dropDuplicates(["lang", "hash"])
    chosen = texts.withColumn("place", place).filter(F.col("place") <= rows)
    found: dict[str, list[str]] = {}
    for row in chosen.select("lang", "place", "piece").orderBy("lang", "place").toLocalIterator():
        found.setdefault(row["lang"], []).append(row["piece"])
    return found


def fit(docs: DataFrame) -> Model:
    return Model(training_sample(docs))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, held_out, lang_pred,
    score`` (0 to 1; higher is surer).

    Whole texts are parsed. Null, empty and letterless texts give ``und`` and
    score 0; ties go to the first language by name; repeated rows and null ids
    (not held out by rule: remainder of the empty text) are kept; an empty
    table gives no rows. Languages and labels are not read here.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    return map_arrow(texts, run, "doc_id long, held_out boolean, lang_pred string, score double")


def drop_unidentified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs``, all columns as they are, without the rows :func:`identify`
    answers with ``und`` (null, empty and letterless texts)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, _ = shared.value.predict(batch.column(place).to_pylist())
            yield batch.filter(pa.array([name != UNKNOWN for name in names], pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def held_out(doc_id):
    return remainder_of_id(doc_id, 3) == 1
