"""Word-piece token counts by a linear longest-match automaton (operator 6).

The vocabulary is a trie.  Each node knows its failure link, the node that the
rest of the text stands at once the longest pieces are cut off its front, and
how many pieces that cuts.  A word then takes one step a symbol and no piece is
ever built: on a missing branch the count of popped pieces is added and the
walk goes on from the failure link.

The vocabulary is that of a byte-level tokenizer: a word is a run between white
space, takes one space before it, and is cut greedily, longest piece first.
Every byte is a piece, so no word is unknown.

Defined results: null and empty texts and texts of white space alone count
zero; repeated rows keep their rows; a null doc_id stays null; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counts of words that a task remembers; they are dropped when it is full.
REMEMBERED = 200_000


def byte_symbols() -> dict[str, int]:
    """The printable symbol that byte-level vocabularies write for each byte.

    Bytes that print stand for themselves; the others, in order, are written
    from U+0100 on.
    """
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_pieces(path: str) -> list[bytes]:
    """The pieces of a tokenizer file's byte-level vocabulary."""
    symbols = byte_symbols()
    with open(path, encoding="utf-8") as f:
        held = json.load(f)["model"]["vocab"]
    return [bytes(symbols[c] for c in piece) for piece in held if all(c in symbols for c in piece)]


class Automaton:
    """A trie with failure links and the counts of pieces they pop."""

    def __init__(self, pieces: Iterable[bytes]):
        kids: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in pieces:
            node = 0
            for b in piece:
                to = kids[node].get(b)
                if to is None:
                    to = kids[node][b] = len(kids)
                    kids.append({})
                    ends.append(False)
                node = to
            ends[node] = node != 0
        fail, popped = [-1] * len(kids), [0] * len(kids)
        level = [(0, b, to) for b, to in kids[0].items()]
        while level:
            after = []
            for parent, b, node in level:
                if ends[node]:
                    fail[node], popped[node] = 0, 1
                else:
                    at, n = fail[parent], popped[parent]
                    while at > 0 and b not in kids[at]:
                        n, at = n + popped[at], fail[at]
                    if at >= 0 and b in kids[at]:
                        fail[node], popped[node] = kids[at][b], n
                after += [(node, x, to) for x, to in kids[node].items()]
            level = after
        self.kids, self.fail, self.popped = kids, fail, popped

    def count(self, word: bytes) -> int:
        """Pieces of word, longest first; -1 if it can't be cut into pieces."""
        kids, fail, popped = self.kids, self.fail, self.popped
        node = total = 0
        for b in word:
            to = kids[node].get(b)
            while to is None:
                if fail[node] < 0:
                    return -1
                total += popped[node]
                node = fail[node]
                to = kids[node].get(b)
            node = to
        while node > 0:
            if fail[node] < 0:
                return -1
            total += popped[node]
            node = fail[node]
        return total


_BUILT: dict[str, Automaton] = {}


def _automaton(path: str) -> Automaton:
    """One automaton a worker, whatever the number of tasks."""
    if path not in _BUILT:
        _BUILT[path] = Automaton(byte_pieces(path))
    return _BUILT[path]


def token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_words, n_tokens) by whole texts."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = _automaton(tokenizer), {}
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1):
                held = (text.as_py() or "").encode("utf-8").split()
                total = 0
                for word in held:
                    n = known.get(word)
                    if n is None:
                        n = automaton.count(b" " + word)
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[word] = n
                    total += n
                words.append(len(held))
                tokens.append(total)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(make, "doc_id long, n_words long, n_tokens long")


def op6_count(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_words and n_tokens for every document."""
    from basewise.llm.packing import default_tokenizer

    return token_counts(docs, tokenizer or default_tokenizer())
