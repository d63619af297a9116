"""Language identification of mixed-language text.

A model of hashed character n-grams is counted over labelled rows: per-word scores are sums of log-likelihoods. The
script of a word, from ranges of code points, narrows its candidates to the languages that were seen in that script.
A Viterbi pass with a penalty for each switch labels every word; runs of one label are spans. The language of a text
is the one with most letters in its spans.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, slices

#: First code points of the ranges, and the script of each range (0: others).
RANGES = [
    (0x0000, "other"), (0x0041, "latin"), (0x02B0, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"),
]
SCRIPTS = sorted({s for _, s in RANGES})
_FIRST = np.array([a for a, _ in RANGES])
_SCRIPT = np.array([SCRIPTS.index(s) for _, s in RANGES])
#: Buckets of the hashed n-grams of 1 to 4 bytes; the model has this many numbers a language.
BUCKETS = 1 << 15
#: Labelled rows that the model is fitted on, at most about; a hash of the key picks them.
SAMPLE = 20_000
#: Cost of a switch, in units of log-likelihood; a span must win by twice that to interrupt another language.
SWITCH = 12.0
#: Share of a language's training words in a script that makes the language a candidate there.
SCRIPT_SHARE = 0.01
#: Bytes of text that are labelled together.
SLICE = 1 << 20
#: Letters of words whose n-grams are scored together: a letter has some four, of 16 bytes and 4 a language at a time.
SCORED = 1 << 14
#: Characters of text whose words are Python strings at a time.
PIECE = 1 << 16
#: Words that a task keeps the scores of, as numbers and as letters: it forgets all of them when they are more.
KNOWN = 1 << 18
_WORD = regex.compile(r"\p{L}+")
_END = regex.compile(r"\P{L}")


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray  # BUCKETS x languages
    allowed: np.ndarray  # scripts x languages

    def score(self, words: list[str]) -> np.ndarray:
        """words x languages: the log-likelihood of each word, minus that of the best language; barred languages get the worst."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        for a, b in _lots(words):
            rows, grams = _grams(words[a:b])
            at = np.searchsorted(rows, np.arange(b - a))
            out[a:b] = np.add.reduceat(self.logp[grams], at, axis=0)
        barred = ~self.allowed[script_of(words)]
        out[barred] = -1e4
        return out - out.max(axis=1, keepdims=True, initial=-1e4)


class Known:
    """Places and scores of the words that a task has met. Most come again, so that few are scored, and of a text's words
    only numbers are held."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.table = np.zeros((0, len(self.model.languages)), np.float32)
        self.size = np.zeros(0, np.int64)

    def codes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of words of each text, and the place of each word in ``table`` and ``size``, until the next call."""
        if self.table.size > KNOWN or self.size.sum() > KNOWN:
            self._forget()
        at, counts, found = self.at, np.zeros(len(texts), np.int64), []
        for i, text in enumerate(texts):
            for words in _words(text):
                found.append(np.fromiter((at.setdefault(w, len(at)) for w in words), np.int32, len(words)))
                counts[i] += len(words)
        fresh = list(islice(at, len(self.size), None))
        if fresh:
            self.table = np.concatenate([self.table, self.model.score(fresh)])
            self.size = np.concatenate([self.size, np.fromiter(map(len, fresh), np.int64, len(fresh))])
        return counts, np.concatenate(found) if found else np.zeros(0, np.int32)


def _words(text: str | None) -> Iterator[list[str]]:
    """The words of a text, in lists of bounded length."""
    start, n = 0, len(text or "")
    while start < n:
        stop = min(n, start + PIECE)
        if stop < n:
            end = _END.search(text, stop)  # no word is cut
            stop = end.start() if end else n
        yield _WORD.findall(text, start, stop)
        start = stop


def _lots(words: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of words with about ``SCORED`` letters each, one word at least."""
    total = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    a = 0
    while a < len(words):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + SCORED, "right")))
        yield a, b
        a = b


def script_of(words: list[str]) -> np.ndarray:
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    return _SCRIPT[np.searchsorted(_FIRST, first, "right") - 1]


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every n-gram of 1 to 4 bytes of " word ", ordered by word."""
    raw = [w.lower().encode() for w in words]
    length = np.fromiter(map(len, raw), np.int64, len(raw)) + 2
    data = np.frombuffer(b" " + b"  ".join(raw) + b" ", np.uint8).astype(np.uint32) if raw else np.zeros(0, np.uint32)
    word = np.repeat(np.arange(len(raw)), length)
    rows, keys, value = [], [], np.zeros(len(data), np.uint32)
    for n in range(1, 5):
        value = (value[: len(data) - n + 1] * np.uint32(257) + data[n - 1 :]) if n > 1 else data
        if n > 1:
            same = word[: len(value)] == word[n - 1 :]
        else:
            same = data != 32
        mixed = (value + np.uint32(n * 0x1234567)) * np.uint32(0x9E3779B1)
        rows.append(word[: len(value)][same])
        keys.append((mixed >> np.uint32(17))[same])
    rows, keys = np.concatenate(rows), np.concatenate(keys)
    order = np.argsort(rows, kind="stable")
    return rows[order], keys[order].astype(np.int64) % BUCKETS


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float, code: np.ndarray | None = None) -> np.ndarray:
    """The best label of each word: scores are those of all texts' words one after another, or code says which of them
    each word has; lengths are the words of each text. All texts go forward together, one word of each at a time."""
    n, m = len(scores) if code is None else len(code), scores.shape[1]
    if not n or not m:
        return np.zeros(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    start = (np.cumsum(lengths) - lengths)[order]
    length = lengths[order]
    steps = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(steps), "left")  # texts with more than t words
    stay = np.ones((n, m), bool)  # whether the best path to a label stays in it
    jump = np.zeros(n, np.int32)  # else the label it comes from
    best = np.zeros((len(lengths), m), np.float32)
    for t in range(steps):
        k = int(alive[t])
        at = start[:k] + t
        own = scores[at if code is None else code[at]]
        if t:
            now = best[:k]
            top = now.argmax(axis=1)
            other = now[np.arange(k), top][:, None] - np.float32(switch)
            keep = now >= other
            stay[at], jump[at] = keep, top
            best[:k] = np.maximum(now, other) + own
        else:
            best[:k] = own
    out = np.zeros(n, np.int64)
    label = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        k = int(alive[t])
        at, now = start[:k] + t, label[:k]
        out[at] = now
        label[:k] = np.where(stay[at, now], now, jump[at])
    return out


def spans(model: Model, texts: list[str | None], switch: float = SWITCH, known: Known | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of all texts: number of words of each text, label, letters. ``known`` serves texts that come one lot after another."""
    known = Known(model) if known is None else known
    counts, code = known.codes(texts)
    return counts, viterbi(known.table, counts, switch, code), known.size[code]


def predict(model: Model, texts: list[str | None], switch: float = SWITCH, known: Known | None = None) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: ``und`` and 0 without letters; the score is the share of letters in the language's spans."""
    counts, label, size = spans(model, texts, switch, known)
    m = len(model.languages)
    row = np.repeat(np.arange(len(texts)), counts)
    mass = np.bincount(row * m + label, size, len(texts) * m).reshape(-1, m) if m else np.zeros((len(texts), 0))
    total = mass.sum(axis=1) if m else np.zeros(len(texts))
    top = mass.argmax(axis=1) if m else np.zeros(len(texts), np.int64)
    names = [model.languages[k] if t > 0 else "und" for k, t in zip(top, total, strict=True)] if m else ["und"] * len(texts)
    return names, np.divide(mass[np.arange(len(texts)), top], total, out=np.zeros(len(texts)), where=total > 0) if m else np.zeros(len(texts))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """A model from rows with a language; rows where it is null don't count, and null texts hold nothing.

    Fitted on a sample of about ``sample`` rows, chosen by a hash of the key; tasks count n-grams, and the sums, at most
    ``BUCKETS`` a language, come to the driver. Without labelled rows every prediction is ``und``.
    """
    bound_batches(labelled.sparkSession)
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    n = rows.count()
    share = min(1.0, sample / max(n, 1))
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64(F.col("k").cast("string"), F.lit("language")), F.lit(1_000_000)) < int(share * 1_000_000))
    counted = rows.select("t", "l").mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(counted.column("lang").to_pylist()))
    where = {x: i for i, x in enumerate(names)}
    lang_at = np.array([where[x] for x in counted.column("lang").to_pylist()], np.int64)
    bucket, n = counted.column("bucket").to_numpy(), counted.column("n").to_numpy()
    table = np.full((BUCKETS, len(names)), 0.5)
    grams = bucket >= 0
    table[bucket[grams], lang_at[grams]] += n[grams]
    scripts = np.zeros((len(SCRIPTS), len(names)))
    scripts[-1 - bucket[~grams], lang_at[~grams]] = n[~grams]
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True  # nobody writes it: nothing to narrow
    return Model(names, np.log(table / table.sum(axis=0)).astype(np.float32), allowed)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams, and of words of each script as bucket -1 - script."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, 0, SLICE):
            for lang in pc.unique(part.column(1)).to_pylist():
                met: Counter[str] = Counter()
                for text in part.column(0).filter(pc.equal(part.column(1), lang)).to_pylist():
                    for words in _words(text):
                        met.update(words)
                have = total.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                distinct, times = list(met), np.fromiter(met.values(), np.int64, len(met))
                for a, b in _lots(distinct):
                    rows, grams = _grams(distinct[a:b])
                    have[:BUCKETS] += np.bincount(grams, times[a:b][rows], BUCKETS).astype(np.int64)
                    have[BUCKETS:] += np.bincount(script_of(distinct[a:b]), times[a:b], len(SCRIPTS)).astype(np.int64)
    for lang, have in total.items():
        at = np.flatnonzero(have)
        bucket = np.where(at < BUCKETS, at, BUCKETS - 1 - at).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(bucket), pa.array(have[at])], names=["lang", "bucket", "n"])


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", switch: float = SWITCH) -> DataFrame:
    """``key, lang_pred, score`` of each row, from the text alone. Whole texts, in batches of bounded bytes; repeated rows repeat."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(shared.value)
        for batch in batches:
            for part in slices(batch, 1, SLICE):
                names, score = predict(shared.value, part.column(1).to_pylist(), switch, known)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["key", "lang_pred", "score"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("t")).mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, lang_pred string, score double")


def language_spans(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", switch: float = SWITCH) -> DataFrame:
    """``key, lang, first_word, n_words, n_letters`` of each span, words counted from 0."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(shared.value)
        for batch in batches:
            for part in slices(batch, 1, SLICE):
                counts, label, size = spans(shared.value, part.column(1).to_pylist(), switch, known)
                if not len(label) or not shared.value.languages:
                    continue
                row = np.repeat(np.arange(len(counts)), counts)
                first = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (row[1:] != row[:-1])]))
                begin = (np.cumsum(counts) - counts)[row[first]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row[first])), pa.array([shared.value.languages[k] for k in label[first]], pa.string()), pa.array(first - begin), pa.array(np.diff(np.append(first, len(label)))), pa.array(np.add.reduceat(size, first))],
                    names=["key", "lang", "first_word", "n_words", "n_letters"],
                )

    return docs.select(F.col(key).alias("key"), F.col(text).alias("t")).mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, lang string, first_word long, n_words long, n_letters long")


def keep_identified(docs: DataFrame, model: Model, text: str = "text", least: float = 0.3, switch: float = SWITCH) -> DataFrame:
    """The rows of docs, all columns, whose language is not ``und`` and has a score of at least ``least``; nothing is shuffled."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(shared.value)
        for batch in batches:
            for part in slices(batch, place, SLICE):
                names, score = predict(shared.value, part.column(place).to_pylist(), switch, known)
                yield part.filter(pa.array([n != "und" and s >= least for n, s in zip(names, score.tolist(), strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
