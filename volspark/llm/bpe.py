"""Byte-pair encoding by backtracking, and decoding from an offset table.

A text is cut at special tokens and then into pieces by the usual byte-level pattern. Each
piece takes the longest token that starts at its front and goes on behind it. Two tokens
may follow each other only if merging by rank would have left them apart; that is read off
the merges by taking both apart step by step, and kept in a table of pairs. Where the
longest token does not fit its left neighbour, the next shorter one that is a prefix of it
is tried; where none fits, the neighbour is taken back and its position closed. No position
is left twice, so a piece costs time in proportion to its length, and the result is exactly
that of merging by rank.

The longest tokens come from an Aho-Corasick automaton over the reversed vocabulary read
from the back of the piece: one pass finds, for every position, the longest token that
starts there. Decoding adds up nothing but slices: all tokens lie in one byte string, and
an offset table says where.

Defined cases: a null text is empty; an empty text has no tokens; equal rows give equal
rows; pieces longer than MAX_CACHED bytes are encoded without being remembered; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import few_at_once

#: How byte-level vocabularies cut a text into pieces (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces remembered per Python worker, and the longest that are.
CACHE, MAX_CACHED = 200_000, 64


def byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = [""] * 256
    for b in plain:
        letters[b] = chr(b)
    for i, b in enumerate(b for b in range(256) if not letters[b]):
        letters[b] = chr(256 + i)
    return letters


class BytePairs:
    """One vocabulary: encodes texts, decodes ids."""

    def __init__(self, definition: str) -> None:
        model = json.loads(definition)
        letters = byte_letters()
        byte = {c: b for b, c in enumerate(letters)}
        vocab = model["model"]["vocab"]
        ids = {bytes(byte[c] for c in token): n for token, n in vocab.items()}
        special = {t["content"]: t["id"] for t in model["added_tokens"]}

        size = max([*ids.values(), *special.values()]) + 1
        text = [b""] * size
        for token, n in ids.items():
            text[n] = token
        for token, n in special.items():
            text[n] = token.encode()
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in text])])
        self.blob = np.frombuffer(b"".join(text), dtype=np.uint8)
        self.length = [len(t) for t in text]

        #: merges by the ids of their parts, and the parts of each token
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for place, merge in enumerate(model["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[left], vocab[right]
            self.rank[pair] = place
            self.parts.setdefault(vocab[left + right], pair)
        self.fits: dict[tuple[int, int], bool] = {}

        #: the longest shorter token that a token begins with, -1 if none
        self.shorter = [-1] * size
        for token, n in ids.items():
            for end in range(len(token) - 1, 0, -1):
                if token[:end] in ids:
                    self.shorter[n] = ids[token[:end]]
                    break

        self.automaton = ahocorasick.Automaton()
        for token, n in ids.items():
            self.automaton.add_word(token[::-1].decode("latin-1"), n)
        self.automaton.make_automaton()

        self.special = special
        self.cut = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}

    def longest(self, piece: bytes) -> list[int]:
        """For every position the longest token that starts there.

        A token that starts at i ends, in the reversed piece, at n - 1 - i; the longest
        one that ends there comes first of all that do.
        """
        n = len(piece)
        best = [-1] * n
        for end, token in self.automaton.iter(piece[::-1].decode("latin-1")):
            at = n - 1 - end
            if best[at] < 0 or self.length[token] > self.length[best[at]]:
                best[at] = token
        return best

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves these two tokens side by side.

        A merge across their border, between the last part of the left and the first of
        the right one, must come later than the merges that built those parts up. Parts are
        undone latest first; a tie goes to the left, as the leftmost merge is done first.
        """
        known = self.fits.get((left, right))
        if known is not None:
            return known
        a, b = left, right
        last = len(self.rank)
        from_left = False
        answer = True
        while True:
            across = self.rank.get((a, b))
            # done before the merge just undone: it would have used up a part. At equal
            # rank the leftmost goes first: the one across only if what it robs is right.
            if across is not None and (across < last or (across == last and not from_left)):
                answer = False
                break
            rank_a = self.rank[self.parts[a]] if a in self.parts else -1
            rank_b = self.rank[self.parts[b]] if b in self.parts else -1
            if rank_a < 0 and rank_b < 0:
                break
            if rank_a > rank_b:
                last, a, from_left = rank_a, self.parts[a][1], True
            else:
                last, b, from_left = rank_b, self.parts[b][0], False
        if len(self.fits) >= 4 * CACHE:
            self.fits.clear()
        self.fits[left, right] = answer
        return answer

    def piece_ids(self, piece: bytes) -> list[int]:
        """Tokens of one piece."""
        best = self.longest(piece)
        n = len(piece)
        if self.length[best[0]] == n:
            return [best[0]]
        length, shorter, fits = self.length, self.shorter, self.compatible
        open_at = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token = 0, best[0]
        while at < n:
            end = at + length[token]
            if open_at[end] and (not out or fits(out[-1], token)):
                out.append(token)
                at = end
                token = best[at] if at < n else -1
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                open_at[at] = 0
                token = out.pop()
                at -= length[token]
                # the token just taken back ends at a closed position and shrinks next
        return out

    def piece(self, piece: str) -> str:
        """Ids of a piece as decimals joined by commas, remembered in two generations."""
        found = self.older.get(piece)
        if found is None:
            raw = piece.encode("utf-8", "surrogatepass")
            found = ",".join(map(str, self.piece_ids(raw)))
            if len(raw) > MAX_CACHED:
                return found
        if len(self.known) >= CACHE:
            self.known, self.older = {}, self.known
        self.known[piece] = found
        return found

    def pieces(self, text: str) -> list[str]:
        new = self.piece
        return [self.known.get(p) or new(p) for p in self.pattern.findall(text)]

    def encode(self, text: str | None) -> tuple[np.ndarray, str]:
        """Ids of a text, and the same as decimals joined by commas."""
        text = text or ""
        found: list[str] = []
        at = 0
        for hit in self.cut.finditer(text) if self.cut else ():
            found += self.pieces(text[at : hit.start()])
            found.append(str(self.special[hit.group()]))
            at = hit.end()
        found += self.pieces(text[at:] if at else text)
        line = ",".join(found)
        return np.fromstring(line, dtype=np.int32, sep=","), line

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        start = self.offsets[ids]
        sizes = self.offsets[ids + 1] - start
        shift = start - (np.cumsum(sizes) - sizes)
        at = np.arange(sizes.sum()) + np.repeat(shift, sizes)
        return self.blob[at].tobytes().decode("utf-8", "replace")


_ready: dict[str, BytePairs] = {}


def _pairs(digest: str, definition: str) -> BytePairs:
    """The vocabulary of a worker, built once per worker."""
    if digest not in _ready:
        _ready[digest] = BytePairs(definition)
    return _ready[digest]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoded(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256, decoded_sha256 of every row.

    The vocabulary file is read by the driver and sent along once; its size does not grow
    with the documents. Rows that follow one another with the same text, as a mix repeats
    them, are encoded once.
    """
    with open(path or default_vocabulary(), encoding="utf-8") as file:
        definition = file.read()
    digest = hashlib.sha256(definition.encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def hashed(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _pairs(digest, shared.value)
        last = done = None
        for batch in few_at_once(batches):
            ids, numbers, sums, texts = [], [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                if done is None or text != last:
                    own, line = pairs.encode(text)
                    last, done = text, (own, hashed(line), hashed(pairs.decode(own)))
                ids.append(done[0] if with_ids else None)
                numbers.append(len(done[0]))
                sums.append(done[1])
                texts.append(done[2])
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []),
                    pa.array(numbers, pa.int64()),
                    pa.array(sums, pa.string()),
                    pa.array(texts, pa.string()),
                ],
                names,
            )

    names = ["doc_id", *["ids"] * with_ids, "n_tokens", "ids_sha256", "decoded_sha256"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {'ids array<int>, ' * with_ids}n_tokens long, "
    return docs.select("doc_id", "text").mapInArrow(
        run, f"{schema}ids_sha256 string, decoded_sha256 string"
    )
