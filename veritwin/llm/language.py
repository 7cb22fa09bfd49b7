"""Language of each word by a linear-chain conditional random field, and of each text by its words.

A word's evidence is a sum of weights of its affixes, its letter trigrams and, for words of the training lexicon,
itself. Learned transitions carry evidence along the text, so that a run of words settles into one
language and code-switched text gets several. Forward-backward gives each word's posterior; the text's language is
the one with the largest mean posterior, which is the score.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scan

#: Runs of letters (general category L): fractions, superscripts and Roman numerals are none.
WORD = regex.compile(r"\p{L}+")
UNKNOWN = "und"
#: Training sample: about so many documents of each language, none longer than this.
SAMPLE_DOCS, SAMPLE_CHARS = 150, 20_000
#: Words of a block; blocks of a text are joined by their transfer matrices, which is exact.
BLOCK = 128
#: Bytes of the words whose evidence is remembered, and words scored at a time.
REMEMBERED, AT_ONCE = 1 << 25, 1 << 17
#: Bytes of a dictionary entry beside its word and its row of evidence.
ENTRY_BYTES = 160


class Model(NamedTuple):
    labels: list[str]
    features: dict[str, int]
    weights: np.ndarray  # feature x label
    transitions: np.ndarray  # label x label, log


def features(word: str) -> list[str]:
    marked = f"^{word}$"
    return [
        "=" + word, "<" + word[:2], "<" + word[:3], ">" + word[-2:], ">" + word[-3:],
        *[marked[k : k + 3] for k in range(len(marked) - 2)],
    ]


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Evidence(dict):
    """Word -> row of ``rows``; each distinct word's features are summed once."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.rows, self.bytes = model, np.zeros((1024, len(model.labels)), np.float32), 0

    def __missing__(self, word: str) -> int:
        n = len(self)
        if n == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        known = self.model.features
        ids = [known[f] for f in features(word) if f in known]
        self.rows[n] = self.model.weights[ids].sum(0)
        self[word] = n
        self.bytes += ENTRY_BYTES + 4 * len(word) + self.rows.itemsize * self.rows.shape[1]
        return n


def posteriors(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each word's label by forward-backward, and the forward vectors; ``emissions`` are the log
    scores of the words of all texts in a row.

    Texts are cut into blocks. The product of a block's step matrices says how it carries any state vector, so the vectors
    at all block borders follow from one short pass over blocks; then all blocks run side by side.
    """
    n_labels = emissions.shape[1]
    step = np.exp(transitions).astype(np.float32)
    em = np.exp(emissions - emissions.max(1, keepdims=True)).astype(np.float32) + np.float32(1e-12)
    pieces = -(-lengths // BLOCK)
    owner = np.repeat(np.arange(len(lengths)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.repeat(np.cumsum(lengths) - lengths, pieces) + nth * BLOCK
    size = np.minimum(BLOCK, np.repeat(lengths, pieces) - nth * BLOCK)
    order = np.argsort(-size, kind="stable")  # the blocks still running at a step come first
    start, size = start[order], size[order]
    running = [int(np.searchsorted(-size, -t, side="left")) for t in range(int(size.max(initial=0)))]

    def scaled(x):
        return x / x.sum(axis=-1, keepdims=True)

    carry = np.tile(np.eye(n_labels, dtype=np.float32), (len(size), 1, 1))
    for t, n in enumerate(running):
        moved = (carry[:n].reshape(-1, n_labels) @ step).reshape(n, n_labels, n_labels) * em[start[:n] + t][:, None, :]
        carry[:n] = moved / moved.sum(axis=(1, 2), keepdims=True)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    first = np.cumsum(pieces) - pieces
    into = np.full((len(size), n_labels), 1 / n_labels, np.float32)
    out_of = np.ones((len(size), n_labels), np.float32)
    for k in range(1, int(pieces.max(initial=0))):
        at = place[first[pieces > k] + k]
        before = place[first[pieces > k] + k - 1]
        into[at] = scaled(np.einsum("bi,bij->bj", into[before], carry[before]))
    for k in range(int(pieces.max(initial=0)) - 1, 0, -1):
        at = place[first[pieces > k] + k]
        before = place[first[pieces > k] + k - 1]
        out_of[before] = scaled(np.einsum("bij,bj->bi", carry[at], out_of[at]))
    ahead, out = np.empty_like(em), np.empty_like(em)
    for t, n in enumerate(running):
        into[:n] = scaled((into[:n] @ step) * em[start[:n] + t])
        ahead[start[:n] + t] = into[:n]
    for t in range(len(running) - 1, -1, -1):
        n = running[t]
        at = start[:n] + t
        out[at] = scaled(ahead[at] * out_of[:n])
        out_of[:n] = scaled((out_of[:n] * em[at]) @ step.T)
    return out, ahead


def summed(rows: np.ndarray, where: np.ndarray, n: int) -> np.ndarray:
    """Rows added up by their place."""
    return np.stack([np.bincount(where, rows[:, k], n) for k in range(rows.shape[1])], axis=1).astype(np.float32)


def train(samples: list[tuple[str, str]], steps: int = 160, seed: int = 7) -> Model:
    """From (language, text): Adagrad over sequences of runs of words from different documents, so that switches are seen."""
    labels = sorted({lang for lang, _ in samples})
    docs = [(lang, words_of(text)) for lang, text in sorted(samples)]
    docs = [d for d in docs if d[1]]
    labels = [x for x in labels if any(lang == x for lang, _ in docs)]
    n_labels = len(labels)
    seen = Counter(w for _, ws in docs for w in ws)
    vocabulary = {w: n for n, w in enumerate(seen)}
    counts = Counter(f for w in vocabulary for f in features(w))
    for w in vocabulary:  # a word is a feature of its own where the sample repeats it
        counts["=" + w] = seen[w]
    known = {f: n for n, f in enumerate(f for f, c in counts.items() if c > 1)}
    of_word = [[known[f] for f in features(w) if f in known] for w in vocabulary]
    width = np.array([len(f) for f in of_word], np.int64)
    flat = np.array([f for fs in of_word for f in fs], np.int64)
    offset = np.cumsum(width) - width
    weights = np.zeros((len(known), n_labels), np.float32)
    transitions = np.full((n_labels, n_labels), -2.0, np.float32)
    np.fill_diagonal(transitions, 2.0)
    power, power_t = np.full_like(weights, 1e-2), np.full_like(transitions, 1e-2)
    rng = np.random.default_rng(seed)
    by_label = [[np.array([vocabulary[w] for w in ws]) for lang, ws in docs if lang == x] for x in labels]
    for _ in range(steps if n_labels > 1 else 0):
        words, gold, lengths = [], [], []
        for _ in range(256):
            runs = []
            for _ in range(rng.integers(1, 5)):
                k = int(rng.integers(n_labels))
                doc = by_label[k][rng.integers(len(by_label[k]))]
                at = int(rng.integers(len(doc)))
                runs.append(doc[at : at + int(rng.integers(4, 33))])
                gold.append(np.full(len(runs[-1]), k))
            words += runs
            lengths.append(sum(map(len, runs)))
        word, true, lengths = np.concatenate(words), np.concatenate(gold), np.array(lengths)
        used, where = np.unique(word, return_inverse=True)
        own = width[used]
        pairs = np.repeat(np.arange(len(used)), own)
        feats = flat[np.arange(own.sum()) + np.repeat(offset[used] - (np.cumsum(own) - own), own)]
        scores = summed(weights[feats], pairs, len(used))
        post, ahead = posteriors(scores[where], lengths, transitions)
        error = -post
        error[np.arange(len(true)), true] += 1
        grad = summed(summed(error, where, len(used))[pairs], feats, len(weights)) / len(lengths) - 1e-5 * weights
        power += grad * grad
        weights += 0.3 * grad / np.sqrt(power)
        # Pairs of neighbours: forward vector x transition x posterior of the later word / what led to it.
        later = np.ones(len(true), bool)
        later[np.cumsum(lengths) - lengths] = False
        b = np.flatnonzero(later)
        matrix = np.exp(transitions)
        expected = matrix * (ahead[b - 1].T @ (post[b] / (ahead[b - 1] @ matrix + 1e-12)))
        observed = np.zeros_like(transitions)
        np.add.at(observed, (true[b - 1], true[b]), 1)
        grad = (observed - expected) / len(lengths) - 1e-3 * transitions
        power_t += grad * grad
        transitions += 0.1 * grad / np.sqrt(power_t)
    return Model(labels, known, weights, transitions)


def sample(docs: DataFrame, text: str, lang: str, key: str, sample_docs: int, sample_chars: int) -> list[tuple[str, str]]:
    """About ``sample_docs`` documents of each language, drawn by a hash of ``key``; the bound holds for any table."""
    usable = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"), F.xxhash64(F.lit(17), f"`{key}`").alias("h")).where(
        F.col("lang").isNotNull() & (F.length("text") <= sample_chars) & F.col("text").rlike(r"\p{L}")
    )
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return []
    drawn = F.lit(False)
    for name, n in counts.items():
        drawn = drawn | ((F.col("lang") == name) & (F.col("h") < int(-(2**63) + 2**64 * min(1.0, sample_docs / n)) - 1))
    rows = usable.where(drawn).select("lang", "text").limit(2 * sample_docs * len(counts) + 100).collect()
    return [(r["lang"], r["text"]) for r in rows]


def learn(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
) -> Model:
    """A model from labelled documents; ``key`` only draws the sample."""
    return train(sample(docs, text, lang, key, sample_docs, sample_chars))


class Tagger:
    """Labels of texts under a model, many texts at a time."""

    def __init__(self, model: Model):
        self.model, self.evidence = model, Evidence(model)

    def word_posteriors(self, texts: list[list[str]]) -> np.ndarray:
        if self.evidence.bytes > REMEMBERED:
            self.evidence = Evidence(self.model)
        ids = np.fromiter((self.evidence[w] for ws in texts for w in ws), np.int64, sum(map(len, texts)))
        return posteriors(self.evidence.rows[ids], np.array([len(ws) for ws in texts]), self.model.transitions)[0]

    def classify(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [(UNKNOWN, 0.0)] * len(texts)
        if not self.model.labels:
            return out
        held, size = [], 0
        for n, text in enumerate(texts):
            words = words_of(text)
            if words:
                held.append((n, words))
                size += len(words)
            if size >= AT_ONCE:
                self._settle(held, out)
                held, size = [], 0
        if held:
            self._settle(held, out)
        return out

    def _settle(self, held: list[tuple[int, list[str]]], out: list) -> None:
        post = self.word_posteriors([ws for _, ws in held])
        lengths = np.array([len(ws) for _, ws in held])
        mean = np.add.reduceat(post.astype(np.float64), np.cumsum(lengths) - lengths, axis=0) / lengths[:, None]
        best = mean.argmax(1)
        for (n, _), k, row in zip(held, best, mean):
            out[n] = (self.model.labels[k], float(min(1.0, row[k])))


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score.

    A text that is null or has no letter is ``und`` with score 0, and so is every text under a model without
    labels. Equal means go to the label that sorts first. Repeated rows get a row each; an empty table gives
    an empty result; no other column is read. The model is bounded by its training sample and is broadcast.
    """
    # Broadcast values are pickled by their class's name, so plain tuples travel: executors need no copy of this package.
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def fn(batches):
        tagger = Tagger(Model(*shared.value))
        for ids, texts in batches:
            found = tagger.classify(texts)
            yield ids, [f[0] for f in found], [f[1] for f in found]

    kind = docs.schema[doc_id].dataType.simpleString()
    return scan(docs, {"doc_id": doc_id, "text": text}, fn, f"doc_id {kind}, lang_pred string, score double")
