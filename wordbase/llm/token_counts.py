"""Numbers of word pieces by a linear longest-match automaton.

The vocabulary is a trie with two roots: one for pieces that start a word and one for pieces that go on. Each
state has a failure link, to the state that remains after the greedily longest pieces have been taken
off, and the number of pieces taken off. A word is then counted in one pass over its bytes: no pieces
are built and no byte is read twice. A word that cannot be cut into pieces counts as one unknown piece.

Defined results: a null or empty text, or one of white space only, has no words and no pieces. One row for each
row of the table, whatever its id. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from wordbase.llm.common import arrow_rows, id_and_text, raw_texts
from wordbase.llm.packing import byte_letters

KNOWN_WORDS = 400_000  #: words whose count a worker remembers before it starts anew
UNKNOWN = -1


class LongestMatch:
    """The automaton. States are numbers; 0 starts a word, 1 goes on with one."""

    def __init__(self, first: list[bytes], more: list[bytes]):
        self.next: dict[int, int] = {}  # state * 256 + byte to state
        ends = {0: False, 1: False}
        for root, pieces in ((0, first), (1, more)):
            for piece in pieces:
                state = root
                for byte in piece:
                    state = self.next.setdefault(state << 8 | byte, len(ends))
                    ends.setdefault(state, False)
                ends[state] = bool(piece) or ends[state]
        # breadth first, so that links of shorter strings are there; a link of None: no way to go on
        self.link: list[int | None] = [None] * len(ends)
        self.taken = [0] * len(ends)
        level = [0, 1]
        children: dict[int, list[tuple[int, int]]] = {}
        for key, to in self.next.items():
            children.setdefault(key >> 8, []).append((key & 255, to))
        while level:
            below = []
            for state in level:
                for byte, child in children.get(state, ()):
                    below.append(child)
                    if ends[child]:
                        self.link[child], self.taken[child] = 1, 1
                        continue
                    back, taken = self.link[state], self.taken[state]
                    while back is not None and back << 8 | byte not in self.next:
                        taken, back = taken + self.taken[back], self.link[back]
                    if back is not None:
                        self.link[child], self.taken[child] = self.next[back << 8 | byte], taken
            level = below
        self.close = [self._closed(s) for s in range(len(ends))]

    def _closed(self, state: int | None) -> int:
        """The pieces still to take off where a word ends."""
        taken = 0
        while state is not None and state != 1:
            taken, state = taken + self.taken[state], self.link[state]
        return UNKNOWN if state is None else taken

    def count(self, word: bytes) -> int:
        """The number of pieces of a word, or ``UNKNOWN``."""
        follow, link, taken = self.next, self.link, self.taken
        state, n = 0, 0
        for byte in word:
            to = follow.get(state << 8 | byte)
            while to is None:
                n += taken[state]
                state = link[state]
                if state is None:
                    return UNKNOWN
                to = follow.get(state << 8 | byte)
            state = to
        rest = self.close[state]
        return UNKNOWN if rest == UNKNOWN else n + rest


def byte_level_pieces(vocabulary: str) -> tuple[list[bytes], list[bytes]]:
    """Pieces of a byte-level vocabulary file: those after a space start words, single bytes may do both."""
    letters = byte_letters()
    space = next(c for c, b in letters.items() if b == 32)
    names = [t for t in json.loads(vocabulary)["model"]["vocab"] if all(c in letters for c in t)]
    first = [bytes(map(letters.__getitem__, t[1:])) for t in names if t[0] == space and len(t) > 1]
    single = [bytes([b]) for b in range(256)]
    return first + single, [bytes(map(letters.__getitem__, t)) for t in names if t[0] != space] + single


@lru_cache(maxsize=2)
def _automaton(vocabulary: str) -> LongestMatch:
    return LongestMatch(*byte_level_pieces(vocabulary))


def piece_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """One row a document: doc_id, n_words, n_pieces, n_unknown; words are parted by ASCII white space."""
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def rows(batches):
        count, known = _automaton(vocabulary.value).count, {}
        for batch in batches:
            out = []
            for text in raw_texts(batch["text"]):
                words = text.split()
                pieces = unknown = 0
                for word in words:
                    n = known.get(word)
                    if n is None:
                        n = known[word] = count(word)
                    if n < 0:
                        unknown, n = unknown + 1, 1
                    pieces += n
                out.append((len(words), pieces, unknown))
                if len(known) > KNOWN_WORDS:
                    known.clear()
            columns = zip(*out, strict=True) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", "n_words", "n_pieces", "n_unknown"],
            )

    return arrow_rows(id_and_text(docs), rows, "doc_id long, n_words long, n_pieces long, n_unknown long")
