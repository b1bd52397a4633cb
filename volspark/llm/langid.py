"""Language of texts, and of the spans within mixed ones.

Words are runs of letters. The script of a word, by code point ranges, narrows its
candidates to languages seen with that script. Every candidate scores the word by its two-
and three-letter sequences (word edges included), a naive Bayes model over hashed counts.
Viterbi then labels the words of a text so that the sum of scores less a penalty per change
of language is greatest, so single odd words follow their surroundings while longer
passages get a label of their own. The language of the text is the one most of its letters
are labelled with. The score is the share of those letters whose script the language
uses, times how far they lie, in mean score per letter, between a background (0) and the
language's own text (1): the background is even chances, or what texts of the other
languages score on average if that is more. So texts in a script or language never learned,
and letter noise, score near 0, the nearer the more was learned.

The model is fitted on a bounded sample: about ``per_language`` documents of each language,
chosen by a hash of the id, whole texts. Its size depends on the number of hash buckets and
languages only. Everything else reads whole texts of all rows.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is every
text where nothing was learned from; words in a script no language was seen with favour
none; ties go to the language that sorts first; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_at_once, free_name

#: Documents learned from per language (expected), and hash buckets.
PER_LANGUAGE, BUCKETS = 2_000, 1 << 15

#: Texts labelled together with up to 16 languages, fewer with more; languages whose counts a
#: task holds before it hands them on.
TOGETHER, HELD = 512, 64

#: Cost of a change of language, and what a script a language does not use costs a word.
PENALTY, STRANGE = 15.0, 50.0

#: Least share of a language's letters in a script for the language to be a candidate.
SCRIPT_SHARE = 0.001

#: Letters scored at once: bounds memory for long texts.
PART = 1 << 20

#: First code points of script ranges and the scripts (fixed values of Unicode blocks).
SCRIPTS = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0700, "other"),
    (0x0750, "arabic"),
    (0x0780, "other"),
    (0x08A0, "arabic"),
    (0x0900, "devanagari"),
    (0x0980, "bengali"),
    (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"),
    (0x0B00, "other"),
    (0x0B80, "tamil"),
    (0x0C00, "telugu"),
    (0x0C80, "kannada"),
    (0x0D00, "malayalam"),
    (0x0D80, "sinhala"),
    (0x0E00, "thai"),
    (0x0E80, "lao"),
    (0x0F00, "tibetan"),
    (0x1000, "myanmar"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "ethiopic"),
    (0x13A0, "other"),
    (0x1780, "khmer"),
    (0x1800, "mongolian"),
    (0x18B0, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x2C60, "latin"),
    (0x2C80, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3130, "hangul"),
    (0x3190, "other"),
    (0x31F0, "kana"),
    (0x3200, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xA720, "latin"),
    (0xA800, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "latin"),
    (0xFB1D, "hebrew"),
    (0xFB50, "arabic"),
    (0xFF00, "other"),
    (0xFF66, "kana"),
    (0xFFA0, "hangul"),
    (0xFFE0, "other"),
    (0x20000, "han"),
    (0x32000, "other"),
)
NAMES = sorted({name for _, name in SCRIPTS})


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@lru_cache(maxsize=1)
def script_table() -> tuple[np.ndarray, np.ndarray]:
    return (
        np.array([start for start, _ in SCRIPTS]),
        np.array([NAMES.index(name) for _, name in SCRIPTS]),
    )


def scripts_of(codes: np.ndarray) -> np.ndarray:
    starts, names = script_table()
    return names[np.searchsorted(starts, codes, side="right") - 1]


class Words:
    """The words of a text, or of a part of it: start and end in letters and in the text."""

    def __init__(self, text: str) -> None:
        raw = text.lower() if len(text.lower()) == len(text) else "".join(
            low if len(low := c.lower()) == 1 else c for c in text
        )
        codes = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = letter_table()[codes]
        edge = np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        padded = np.zeros(len(codes) + 2, dtype=np.uint64)
        padded[1:-1][letter] = codes[letter]
        at = np.flatnonzero(letter) + 1
        before, here, after = padded[at - 1], padded[at], padded[at + 1]
        pair = here * np.uint64(0x9E3779B97F4A7C15) + before * np.uint64(0xC2B2AE3D27D4EB4F)
        both = pair + (after + np.uint64(1)) * np.uint64(0x165667B19E3779F9)
        shift, half = np.uint64(33), np.uint64(BUCKETS // 2)
        mixed = np.uint64(0xFF51AFD7ED558CCD)
        # pairs in one half of the buckets, triples in the other
        self.pairs = (((pair ^ (pair >> shift)) * mixed >> shift) % half).astype(np.int64)
        self.triples = ((both ^ (both >> shift)) * mixed >> shift) % half + half
        self.triples = self.triples.astype(np.int64)
        self.first = np.cumsum(self.end - self.start) - (self.end - self.start)
        self.script = scripts_of(codes[self.start])

    @property
    def letters(self) -> np.ndarray:
        return self.end - self.start


def parts(text: str, languages: int = 4) -> Iterator[tuple[int, str]]:
    """A text in parts of about PART characters, cut where no word is; with their offsets.

    Less than PART where more than four languages are scored.
    """
    at = 0
    size = max(1, PART * 4 // max(4, languages))
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and text[end - 1].isalpha() and text[end].isalpha():
            end += 1
        yield at, text[at:end]
        at = end


class Model:
    """Scores of hashed letter sequences and scripts in use, by language."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray) -> None:
        """counts: buckets by language; scripts: letters by script and language."""
        self.languages = languages
        total = counts.sum(axis=0, keepdims=True)
        self.log = np.log((counts + 0.1) / (total + 0.1 * len(counts))).astype(np.float32)
        share = scripts / np.maximum(1, scripts.sum(axis=0, keepdims=True))
        self.uses = share >= SCRIPT_SHARE
        # mean score per letter (a pair and a triple) of a language's texts in another: from, in
        part = counts / np.maximum(1, total)
        mean = 2 * (part.T @ self.log.astype(np.float64))
        self.own = np.diag(mean).copy()
        learned = total[0] > 0
        # where less was learned than there are buckets, new sequences say little
        self.weight = total[0] / (total[0] + len(counts))
        others = mean[learned].sum(axis=0) - np.where(learned, self.own, 0)
        others = others / np.maximum(1, learned.sum() - learned)
        even = -2 * np.log(len(counts))
        self.base = np.where(learned.sum() - learned > 0, np.maximum(others, even), even)

    def nearness(self, mean: float, language: int) -> float:
        """Where a mean score per letter lies between background and own text, 0 to 1."""
        room = self.own[language] - self.base[language]
        near = float(np.clip((mean - self.base[language]) / room, 0, 1)) if room > 0 else 0.0
        return 1 - self.weight[language] * (1 - near)

    def scores(self, words: Words) -> np.ndarray:
        """Score of every word (row) in every language."""
        if not len(words.start) or not self.languages:
            return np.zeros((len(words.start), len(self.languages)), dtype=np.float32)
        letters = self.log[words.pairs] + self.log[words.triples]
        found = np.add.reduceat(letters, words.first, axis=0)
        candidate = self.uses[words.script]
        none = ~candidate.any(axis=1)
        found[none] = 0
        floor = found.min(axis=1, keepdims=True) - STRANGE
        return np.where(candidate | none[:, None], found, floor)


def viterbi(scores: list[np.ndarray], penalty: float = PENALTY) -> list[np.ndarray]:
    """Best labels for each sequence of word scores; all sequences step together.

    Sequences are sorted by length, so that those still running are the first rows.
    """
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    sizes = np.array([len(scores[i]) for i in order])
    if not len(sizes) or not sizes[0]:
        return [np.zeros(0, dtype=np.int16) for _ in scores]
    # sequences longer than t, for every t
    running = (len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), side="right")).tolist()
    offset = np.cumsum(sizes) - sizes
    flat = np.concatenate([scores[i] for i in order])
    # best[d, l]: sum up to here with this word in language l
    best = flat[offset[: running[0]]].astype(np.float64)
    stay = np.ones(flat.shape, dtype=bool)
    source = np.zeros(len(flat), dtype=np.int16)
    final = np.zeros(len(sizes), dtype=np.int16)
    for t in range(1, int(sizes[0]) + 1):
        alive = running[t] if t < len(running) else 0
        if alive < len(best):
            final[alive : len(best)] = best[alive:].argmax(axis=1)
            best = best[:alive]
        if not alive:
            break
        at = offset[:alive] + t
        top = best.argmax(axis=1)
        change = best[np.arange(alive), top][:, None] - penalty
        kept = best >= change
        stay[at], source[at] = kept, top
        best = np.where(kept, best, change) + flat[at]
    labels = np.zeros(len(flat), dtype=np.int16)
    now = final.copy()
    for t in range(int(sizes[0]) - 1, -1, -1):
        alive = running[t]
        at = offset[:alive] + t
        labels[at] = now[:alive]
        now[:alive] = np.where(stay[at, now[:alive]], now[:alive], source[at])
    out = [np.zeros(0, dtype=np.int16)] * len(scores)
    for place, i in enumerate(order):
        out[i] = labels[offset[place] : offset[place] + sizes[place]]
    return out


def label(texts: list[str | None], model: Model, spans: bool) -> list[tuple]:
    """(language, score, spans) of each text; spans are (start, end, language)."""
    out: list[tuple] = []
    few = max(1, TOGETHER * 16 // max(16, len(model.languages)))
    for first in range(0, len(texts), few):
        own = texts[first : first + few]
        scores, where = [], []
        for text in own:
            pieces = [(at, Words(part)) for at, part in parts(text or "", len(model.languages))]
            empty = np.zeros((0, len(model.languages)), dtype=np.float32)
            scores.append(np.concatenate([empty, *(model.scores(w) for _, w in pieces)]))
            starts = np.concatenate([np.zeros(0, int), *(at + w.start for at, w in pieces)])
            script = np.concatenate([np.zeros(0, int), *(w.script for _, w in pieces)])
            ends = np.concatenate([np.zeros(0, int), *(at + w.end for at, w in pieces)])
            where.append((starts, ends, script))
        paths = viterbi(scores) if model.languages else [None] * len(own)
        for found, path, (starts, ends, script) in zip(scores, paths, where):
            if path is None or not len(path):
                out.append(("und", 0.0, []))
                continue
            # no letters for words in a script that their language does not use
            sizes = np.where(model.uses[script, path], ends - starts, 0)
            letters = np.bincount(path, weights=sizes, minlength=len(model.languages))
            winner = int(letters.argmax())
            runs = []
            if spans:
                new = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
                last = np.r_[new[1:], len(path)] - 1
                runs = [
                    {"start": int(starts[a]), "end": int(ends[b]), "lang": model.languages[path[a]]}
                    for a, b in zip(new, last)
                ]
            score = min(1.0, float(letters[winner] / (ends - starts).sum()))
            if score:
                own = (path == winner) & (sizes > 0)
                mean = found[own, winner].sum(dtype=np.float64) / letters[winner]
                score *= model.nearness(mean, winner)
            out.append((model.languages[winner], score, runs))
    return out


def held_out(doc_id: Column) -> Column:
    """Documents kept from learning: crc32 of the id's text, by 5, leaves 0."""
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(5)) == 0


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model of all languages of ``docs`` (doc_id, text, lang), held-out rows left aside."""
    known = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    known = known.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    numbers = known.groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in numbers)
    # a language's rows whose hash falls in its share of all hashes
    span = 1 << 31
    shares = [(r["lang"], min(span, span * per_language // r["count"] + 1)) for r in numbers]
    shares = docs.sparkSession.createDataFrame(shares, "lang string, below long")
    # one row per label, as many as the model has columns
    known = known.join(F.broadcast(shares), "lang")
    chosen = known.filter(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(span)) < F.col("below"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in few_at_once(batches):
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                if lang not in counts and len(counts) == HELD:
                    yield from handed_on(counts)
                    counts = {}
                total = counts.setdefault(lang, np.zeros(BUCKETS + len(NAMES), dtype=np.int64))
                for _, part in parts(text.as_py() or ""):
                    words = Words(part)
                    total[:BUCKETS] += np.bincount(words.pairs, minlength=BUCKETS)
                    total[:BUCKETS] += np.bincount(words.triples, minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(
                        words.script, weights=words.letters, minlength=len(NAMES)
                    ).astype(np.int64)
        yield from handed_on(counts)

    def handed_on(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, total in counts.items():
            place = np.flatnonzero(total)
            yield pa.record_batch(
                [
                    pa.array([lang] * len(place), pa.string()),
                    pa.array(place.astype(np.int32)),
                    pa.array(total[place]),
                ],
                ["lang", "place", "n"],
            )

    found = chosen.select("text", "lang").mapInArrow(run, "lang string, place int, n long")
    sums = found.groupBy("lang", "place").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((BUCKETS + len(NAMES), len(languages)), dtype=np.float64)
    column = {lang: i for i, lang in enumerate(languages)}
    if len(sums):
        of = np.array([column[x] for x in sums.column("lang").to_pylist()])
        table[sums.column("place").to_numpy(), of] = sums.column("n").to_numpy()
    return Model(languages, table[:BUCKETS], table[BUCKETS:])


def languages(docs: DataFrame, model: Model, spans: bool = True) -> DataFrame:
    """doc_id, lang_pred, score and (if asked for) spans of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "lang_pred", "score", *["spans"] * spans]
    kind = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches):
            found = label([t.as_py() for t in batch.column("text")], shared.value, spans)
            columns = [
                batch.column("doc_id"),
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ]
            if spans:
                columns.append(pa.array([f[2] for f in found], kind))
            yield pa.record_batch(columns, names)

    own = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {own}, lang_pred string, score double"
    if spans:
        schema += ", spans array<struct<start: bigint, end: bigint, lang: string>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def with_language(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose text has a language: not ``und``, score at least ``least``.

    All columns. The texts are not shuffled: each row is judged where it lies.
    """
    model = fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    row = free_name(docs, "row")
    packed = docs.select(
        F.col("text").cast("string").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches):
            found = label([t.as_py() for t in batch.column(0)], shared.value, False)
            keep = pa.array([f[0] != "und" and f[1] >= least for f in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(1)], [row]).filter(keep)

    return packed.mapInArrow(run, packed.select(row).schema).select(f"{row}.*")
