"""Token counts by greedy longest match, in one pass over the bytes.

The vocabulary is a trie with failure links. Where no edge goes on from a node, the pieces
greedy matching would cut off there are known in advance; only their number is stored, and
the failure link leads to the node for what is left over. So a word costs one step per byte
and no piece is ever built.

Words are split at white space; a word is matched as ``start`` + word + ``end``, and what
follows its first piece as ``joint`` + rest, as word-piece vocabularies do ("##"). A word that
the vocabulary cannot spell counts as one token.

Defined cases: a null or empty text has 0 words and 0 tokens; equal rows give equal rows; an
empty table gives an empty result. Words longer than MAX_CACHED bytes are counted without
being remembered.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter, deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import few_at_once

#: Words remembered per Python worker, and the longest that are.
CACHE, MAX_CACHED = 300_000, 64


class Matcher:
    """The automaton over one vocabulary of byte strings."""

    def __init__(
        self, vocabulary: Iterable[bytes], start: bytes = b"", joint: bytes = b"", end: bytes = b""
    ) -> None:
        self.start, self.end = start, end
        self.edges: list[dict[int, int]] = [{}]
        token = [False]

        def node_of(string: bytes) -> int:
            node = 0
            for byte in string:
                step = self.edges[node].get(byte)
                if step is None:
                    step = self.edges[node][byte] = len(self.edges)
                    self.edges.append({})
                    token.append(False)
                node = step
            return node

        self.rest = node_of(joint)
        for string in vocabulary:
            if string:
                token[node_of(string)] = True
        self.link = [-1] * len(self.edges)
        self.popped = [0] * len(self.edges)
        queue = deque([0] if self.rest == 0 else [0, self.rest])
        seen = {0, self.rest}
        while queue:
            parent = queue.popleft()
            for byte, node in self.edges[parent].items():
                if node in seen:
                    continue
                seen.add(node)
                queue.append(node)
                if token[node]:
                    self.link[node], self.popped[node] = self.rest, 1
                    continue
                at, popped = self.link[parent], self.popped[parent]
                while at >= 0 and byte not in self.edges[at]:
                    popped += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[node], self.popped[node] = self.edges[at][byte], popped

    def count(self, word: bytes) -> int:
        edges, link, popped = self.edges, self.link, self.popped
        node = total = 0
        for byte in self.start + word + self.end:
            step = edges[node].get(byte)
            while step is None:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return 1
                step = edges[node].get(byte)
            node = step
        while node != self.rest:
            total += popped[node]
            node = link[node]
            if node < 0:
                return 1
        return total


def byte_strings(path: str) -> list[bytes]:
    """The tokens of a byte-level vocabulary file, as bytes.

    The file writes bytes as characters: printable ones as themselves, the others in order
    from code point 256 on.
    """
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["model"]["vocab"]
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    return [bytes(byte[c] for c in t) for t in sorted(tokens, key=tokens.get)]


_ready: dict = {}


def _matcher(key: tuple, vocabulary: list[bytes]) -> tuple[Matcher, dict[bytes, int]]:
    """The automaton of a worker and its remembered words, built once per worker and vocabulary.

    ``key`` tells vocabularies apart by all their tokens.
    """
    if key not in _ready:
        _ready[key] = Matcher(vocabulary, *key[1:]), {}
    return _ready[key]


def text_counts(text: str | None, matcher: Matcher, known: dict[bytes, int]) -> tuple[int, int]:
    """(words, tokens) of a whole text."""
    words = Counter((text or "").encode("utf-8", "surrogatepass").split())
    total = 0
    for word, times in words.items():
        pieces = known.get(word)
        if pieces is None:
            pieces = matcher.count(word)
            if len(word) <= MAX_CACHED:
                if len(known) >= CACHE:
                    known.clear()
                known[word] = pieces
        total += pieces * times
    return words.total(), total


def token_counts(
    docs: DataFrame,
    vocabulary: list[bytes],
    start: bytes = b" ",
    joint: bytes = b"",
    end: bytes = b"",
) -> DataFrame:
    """doc_id, n_words, n_tokens of every row. The vocabulary is sent along once: its size
    does not grow with the documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    told = hashlib.sha256()
    for string in vocabulary:
        told.update(len(string).to_bytes(4, "big") + string)
    key = (told.digest(), start, joint, end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, known = _matcher(key, shared.value)
        for batch in few_at_once(batches):
            counts = [text_counts(t.as_py(), matcher, known) for t in batch.column("text")]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([a for a, _ in counts], pa.int64()),
                    pa.array([b for _, b in counts], pa.int64()),
                ],
                ["doc_id", "n_words", "n_tokens"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_tokens long"
    )
