"""Quality by random-indexing word vectors, pooled per document, and a two-layer numpy network.

Random indexing: every word has a sparse index vector of SEEDS ones and minus ones at places that its hash gives; a
word of the sample's vocabulary also gathers the index vectors of its neighbours (up to SPAN words away). Both
together are its vector; words outside the vocabulary have an index vector alone, that of the one of BUCKETS their hash gives, so that
the model is of fixed size. Besides the word itself, a token
stands for its shape (case, digits, each run of punctuation) and for repeating the word before it, so that junk of words never
met looks like junk of known words. A document is the mean of its tokens' vectors; the first layer is linear up to there, so each distinct
token is put through it once. Two layers (HIDDEN relu units) give a logit, whose temperature (and a shift, as 0.5 is to be the border) is calibrated
on a part of the sample the layers were not trained on.

The fit takes a bounded sample of labelled rows (labelled.sample: at most 2,000 of either label, 16 million characters);
scoring takes whole texts. Defined cases: a text without tokens (null and empty too) is a vector of zeros and has the
network's score for it; without labels of both kinds in the sample every score is 0; a row for each input row. No shuffle to score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from brindle.llm.common import bounded_batches, column, pieces, take_turn, tidy, unused
from brindle.llm.labelled import add_rows, fold, sample, sigmoid, temperature

DIM, SEEDS, SPAN, HIDDEN, VOCABULARY, BUCKETS = 128, 6, 2, 24, 20_000, 1 << 14
MOST, MOST_CHARS = 2000, 16_000_000


def forms(word: bytes) -> list[str]:
    """What a token stands for: its letters, their case, and each run of punctuation."""
    w = word.decode("utf-8", "replace")
    core = w.strip(_PUNCT)
    out = [core.lower()] if core else []
    if len(core) > 1 and core.isupper():
        out.append("\x00upper")
    elif core[:1].isupper():
        out.append("\x00title")
    if not core.isalpha() and any(map(str.isdigit, core)):
        out.append("\x00digit")
    if len(core) > 20:
        out.append("\x00long")
    if w.isalnum():
        return out
    return out + [f"\x00{a}{'+' * bool(b)}" for a, b in _MARKS.findall(w)]


_MARKS = re.compile(r"([^\w\s])(\1*)")


_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
AGAIN = "\x00again"


def index_vectors(words: list[str]) -> np.ndarray:
    """Sparse random vectors that the words' hashes alone decide."""
    out = np.zeros((len(words), DIM), np.float32)
    for k in range(SEEDS):
        h = np.array([zlib.crc32(w.encode("utf-8", "replace"), 0x9E3779B9 * (k + 1) & 0xFFFFFFFF) for w in words], np.int64).reshape(-1)
        out[np.arange(len(words)), (h >> 1) % DIM] += np.where(h & 1, 1.0, -1.0)
    return out / np.sqrt(SEEDS)


class Model:
    """The hashed or learned first-layer image of each form, the network, the calibration."""

    def __init__(self, names: dict[str, int], image: np.ndarray, layers: tuple, scale: float, shift: float):
        self.names, self.image, self.layers, self.scale, self.shift = names, image, layers, scale, shift
        self.known: dict[bytes, int] = {}
        self.rows = np.zeros((0, image.shape[1] + 1), np.float32)

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "rows": self.rows[:0]}

    def forget(self) -> None:
        self.known, self.rows, self._room = {}, self.rows[:0].copy(), None

    def _form(self, f: str) -> int:
        at = self.names.get(f)
        return len(self.names) + zlib.crc32(f.encode("utf-8", "replace")) % BUCKETS if at is None else at

    def _images(self, words: list[bytes]) -> np.ndarray:
        """For each word the sum of its forms' images, and their number."""
        own = [forms(w) for w in words]
        out = np.zeros((len(words), self.image.shape[1] + 1), np.float32)
        ids = np.fromiter((self._form(f) for fs in own for f in fs), np.int64)
        owner = np.repeat(np.arange(len(words)), [len(fs) for fs in own])
        add_rows(out[:, :-1], owner, self.image[ids])
        out[:, -1] = [len(fs) for fs in own]
        return out

    def pooled(self, text: str, keep: int = 150_000) -> np.ndarray:
        """The mean image of a text's tokens."""
        total = np.zeros(self.image.shape[1] + 1)
        last = None
        for piece in pieces(text):
            words = piece.encode().split()
            if not words:
                continue
            ids = list(map(self.known.get, words))
            rows = self.rows
            if None in ids:
                new = list({w for w, k in zip(words, ids, strict=True) if k is None})
                made = self._images(new)
                at = {w: len(rows) + k for k, w in enumerate(new)}
                ids = [at[w] if k is None else k for w, k in zip(words, ids, strict=True)]
                # rows of the words that are kept stand first, at the places that `known` gives
                if len(self.known) + len(new) <= keep:
                    grown = self._grown(made)
                    rows = grown
                    self.known |= at
                else:
                    rows = None
                    old = np.array([k for k in ids if k < len(self.rows)], np.int64)
                    fresh = np.array([k - len(self.rows) for k in ids if k >= len(self.rows)], np.int64)
                    total += self.rows[old].sum(0, dtype=np.float64) + made[fresh].sum(0, dtype=np.float64)
            if rows is not None:
                total += rows[np.array(ids)].sum(0, dtype=np.float64)
            again = int(np.count_nonzero(np.diff(np.array(ids)) == 0)) + (last == words[0])
            total[:-1] += again * self.image[self.names[AGAIN]]
            total[-1] += again
            last = words[-1]
        return total[:-1] / max(total[-1], 1)

    def _grown(self, made: np.ndarray) -> np.ndarray:
        """The kept rows with the new ones; room doubles, so growing costs as much as what is kept."""
        n = len(self.rows)
        room = getattr(self, "_room", None)
        if room is None or len(room) < n + len(made):
            bigger = np.zeros((max(1024, 2 * (n + len(made))), made.shape[1]), np.float32)
            bigger[:n] = self.rows
            self._room = room = bigger
        room[n : n + len(made)] = made
        self.rows = room[: n + len(made)]
        return self.rows

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        b1, w2, b2 = self.layers
        return np.maximum(pooled + b1, 0) @ w2 + b2

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return sigmoid(self.scale * self.logits(np.stack([self.pooled(t) for t in texts])) + self.shift)


def fit(rows: list[tuple[str, int]], seed: int = 1) -> Model | None:
    """The model for (text, 0 or 1) rows; None without both labels."""
    y = np.array([k for _, k in rows], float)
    if len(set(y.tolist())) < 2:
        return None
    forms_of = lru_cache(None)(forms)  # over the words of the bounded sample
    docs = []
    for text, _ in rows:
        words = text.encode().split()
        docs.append([f for a, b in zip([b"", *words], words) for f in [*forms_of(b), *([AGAIN] if a == b else [])]])
    count = Counter(f for d in docs for f in set(d))
    vocabulary = [w for w, n in sorted(count.items(), key=lambda x: (-x[1], x[0]))[:VOCABULARY] if n >= 3 and w != AGAIN]
    names = {w: k for k, w in enumerate([AGAIN, *vocabulary])}
    own = index_vectors(list(names))
    hashed = index_vectors([f"\x01{k}" for k in range(BUCKETS)])
    vectors = np.concatenate([own, hashed])
    probe = Model(names, vectors, (), 1, 0)

    numbered = [np.array([probe._form(f) for f in d], np.int64) for d in docs]
    near = np.zeros_like(own)
    for ids in numbered:
        for gap in range(1, SPAN + 1):
            for a, b in ((ids[gap:], ids[:-gap]), (ids[:-gap], ids[gap:])):
                known = a < len(names)
                add_rows(near, a[known], vectors[b[known]])
    # of a word's neighbours, what all words' neighbours have in common says nothing
    near -= near.sum(1, keepdims=True) / DIM
    norm = np.linalg.norm(near, axis=1, keepdims=True)
    vectors[: len(names)] += 0.5 * near / np.maximum(norm, 1e-9)

    pooled = np.stack([vectors[ids].mean(0) if len(ids) else np.zeros(DIM) for ids in numbered])
    rng = np.random.default_rng(seed)
    part = rng.permutation(len(y))
    held, train = part[: len(y) // 5], part[len(y) // 5 :]
    scale = pooled[train].std(0) + 1e-6
    w1, b1, w2, b2 = _train(pooled[train] / scale, y[train], rng)
    w1 = w1 / scale[:, None]
    model = Model(names, (vectors @ w1).astype(np.float32), (b1, w2, b2), 1.0, 0.0)
    logits = model.logits(pooled @ w1)
    # where the held part lacks a label, calibrate on all
    use = held if len(set(y[held].tolist())) == 2 else part
    # equal classes in the sample are not equal outside it, but 0.5 stays the border between what looks like either
    model.scale, model.shift = temperature(logits[use], y[use])
    return model


def _train(x: np.ndarray, y: np.ndarray, rng, steps: int = 1500, rate: float = 0.01, batch: int = 128):
    """Adam on two layers with weight decay."""
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), np.zeros(())]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weight = np.where(y == 1, len(y) / 2 / max(1, y.sum()), len(y) / 2 / max(1, (1 - y).sum()))
    for t in range(1, steps + 1):
        k = rng.integers(0, len(y), batch)
        w1, b1, w2, b2 = params
        h = np.maximum(x[k] @ w1 + b1, 0)
        g = (sigmoid(h @ w2 + b2) - y[k]) * weight[k] / batch
        gh = np.outer(g, w2) * (h > 0)
        grads = [x[k].T @ gh + 1e-3 * w1, gh.sum(0), h.T @ g + 1e-3 * w2, g.sum()]
        for i, d in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * d
            v[i] = 0.999 * v[i] + 0.001 * d**2
            params[i] = params[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return params


def scored(docs: DataFrame, model: Model | None, carry: tuple[str, ...] = (), name: str = "_score") -> DataFrame:
    """doc_id, the carried columns and `name`, the score (0 to 1), of each row of docs (doc_id, text)."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # VOCABULARY and BUCKETS rows: fixed size
    kept, text = list(dict.fromkeys(["doc_id", *carry])), unused(docs, "_text")

    def forget() -> None:
        if sent.value:
            sent.value.forget()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        take_turn("quality")
        for batch in batches:
            texts = [t or "" for t in column(batch, text)]
            s = pa.array(m.scores(texts) if m else np.zeros(len(texts)), pa.float64())
            own = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*own, s], names=[*kept, name])

    schema = StructType([*(docs.schema[c] for c in kept), StructField(name, DoubleType())])
    return docs.select(*kept, F.col("text").cast("string").alias(text)).mapInArrow(tidy(run, forget), schema)


def fit_on(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> Model | None:
    return fit(sample(docs, labels, "quality", fold(n=folds) != held_out, MOST, MOST_CHARS))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs; labels of the held-out fold are not read."""
    return scored(docs, fit_on(docs, labels)).select("doc_id", (fold(n=3) == 1).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))
