"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (3 to 5 characters of `<word>`, and the whole), each with an embedding of its own
in a hashed table; words that were never met, and misspellings, share the n-grams of those that were. Words are parted by Unicode
white space; of a run of more than LONGEST characters (scripts without spaces, minified code) each part up to punctuation is a word, and of
a part still longer each piece of LONGEST, which overlap so that no n-gram is lost. The embeddings of a
window of WINDOW words (two: in longer ones a lone toxic word drowns) are averaged and go into a linear softmax over (clean, toxic); embeddings and softmax are trained jointly
in numpy. A document's logit is the mean of those of its WORST most toxic windows (of all, where it has fewer; windows over its edges have empty places), so a few words count in a text of
any length, and one word that merely looks like a toxic one does not decide.

Labels are of documents, so the windows to train on are chosen and chosen again: first by how much more often words
stand in toxic documents, then by the model itself; from clean documents come their own worst windows and others. At
the end the documents' logits are calibrated (scale and shift).

The fit takes a bounded sample of labelled rows (labelled.sample: at most 1,500 of either label, 16 million characters);
scoring takes whole texts. Defined cases: a text without words (null and empty too) has the score of the bias alone; without
labels of both kinds in the sample every score is 0; a row for each row of the input, repeated ones too. No shuffle to score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from brindle.llm.common import KEPT_BYTES, bounded_batches, column, pieces, release, take_turn, tidy, unused
from brindle.llm.labelled import add_rows, fold, sample, sigmoid, temperature

BUCKETS, DIM, WINDOW, WORST, ROUNDS, EPOCHS = 1 << 17, 12, 2, 4, 3, 12
LONGEST, OVERLAP = 64, 4
MOST, MOST_CHARS = 1500, 16_000_000


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of words (UTF-8; in lower case, without punctuation at their ends): the bucket of each, and the place of its word.

    All at once: characters of all words in one array, hashed over each run of 3, 4 and 5 that lies in a word; and each word as a whole.
    """
    text = [w.decode("utf-8", "replace") for w in words]
    text = [f"<{t.lower().strip(_PUNCT) or t}>" for t in text]
    size = np.fromiter(map(len, text), np.int64, len(text))
    code = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(text)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(code))  # characters from here to the word's end
    h = np.full(len(code), 0x9E3779B97F4A7C15, np.uint64)
    found, of = [], []
    for n in range(1, 6):
        h = h[: max(0, len(code) - n + 1)]
        h = (h ^ code[n - 1 :]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        if n >= 3:
            inside = left[: len(h)] >= n
            found.append(h[inside] + np.uint64(n))
            of.append(owner[: len(h)][inside])
    found.append(np.fromiter((zlib.crc32(t.encode("utf-8", "replace")) for t in text), np.uint64, len(text)))
    of.append(np.arange(len(text)))
    x = np.concatenate(found)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(of)


def _by_word(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words' n-grams one after another, and how many each word has."""
    ids, owner = grams(words)
    return ids[np.argsort(owner, kind="stable")].astype(np.int32), np.bincount(owner, minlength=len(words)).astype(np.int32)


_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words_of(text: str) -> list[bytes]:
    out = []
    for p in pieces(text):
        for w in p.split():
            if len(w) <= LONGEST:
                out.append(w.encode())
            else:
                out += _parts(w)
    return out


_PART = re.compile(r"[^\W_]*+[\W_]++|[^\W_]++")  # a word with the punctuation behind it


def _parts(run: str) -> Iterator[bytes]:
    for m in _PART.finditer(run):
        w = m[0]
        for at in range(0, max(1, len(w) - OVERLAP), LONGEST - OVERLAP):
            yield w[at : at + LONGEST].encode()


class Model:
    """What scoring needs: a scalar for each bucket (the embedding through the softmax), bias, calibration."""

    def __init__(self, buckets: np.ndarray, bias: float, scale: float, shift: float):
        self.buckets, self.bias, self.scale, self.shift = buckets, bias, scale, shift
        self.known: dict[bytes, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def word_scores(self, words: list[bytes], keep: int = 250_000) -> np.ndarray:
        got = list(map(self.known.get, words))
        if None in got:
            places = [k for k, x in enumerate(got) if x is None]
            new = list({words[k] for k in places})
            made = {}
            for at in range(0, len(new), 4096):
                some = new[at : at + 4096]
                ids, owner = grams(some)
                means = np.bincount(owner, self.buckets[ids], len(some)) / np.bincount(owner, minlength=len(some))
                made |= zip(some, means.tolist(), strict=True)
            for k in places:
                got[k] = made[words[k]]
            if len(self.known) + len(made) <= keep:
                self.known |= {w: x for w, x in made.items() if len(w) <= KEPT_BYTES}
        return np.array(got)

    def windows(self, words: list[bytes]) -> np.ndarray:
        """Logits of all windows, those over an edge of the text too; the whole text is the one window of a shorter text."""
        return _means(_edged(self.word_scores(words))) + self.bias

    def logit(self, words: list[bytes]) -> float:
        return _worst(self.windows(words))

    def scores(self, texts: list[str]) -> list[float]:
        return [float(sigmoid(self.scale * self.logit(words_of(t)) + self.shift)) for t in texts]


def fit(rows: list[tuple[str, int]], seed: int = 1) -> Model | None:
    """The model for (text, 0 or 1) rows; None without both labels."""
    number: dict[bytes, int] = {}  # documents are arrays of words' numbers
    docs = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int32) for t, _ in rows]
    y = np.array([y for _, y in rows])
    keep = [k for k, d in enumerate(docs) if len(d)]
    docs, y = [docs[k] for k in keep], y[keep] if len(keep) else y[:0]
    if len(set(y.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    words = list(number)
    del number
    parts = [_by_word(words[k : k + 4096]) for k in range(0, len(words), 4096)]
    ids, size = np.concatenate([i for i, _ in parts]), np.concatenate([n for _, n in parts])
    del parts
    at = np.concatenate(([0], np.cumsum(size)))

    def firsts() -> np.ndarray:
        """Each word's log odds to stand in toxic documents; words met in one or two documents say little."""
        cores: dict[bytes, int] = {}
        core = np.array([cores.setdefault(w.lower().strip(_PUNCT.encode()), len(cores)) for w in words])
        df = np.zeros((2, len(cores)))
        for d, k in zip(docs, y, strict=True):
            df[k, np.unique(core[d])] += 1
        n = np.bincount(y, minlength=2)
        odds = np.log((df[1] + 0.5) / (n[1] + 1)) - np.log((df[0] + 0.5) / (n[0] + 1))
        return np.where((df[1] > 0) & (df.sum(0) > 2), odds, 0.0)[core]

    emb = rng.normal(0, 0.05, (BUCKETS, DIM))
    out, bias = rng.normal(0, 0.1, (DIM, 2)), np.zeros(2)
    score, model = firsts(), None
    for _ in range(ROUNDS):
        chosen: list[tuple[np.ndarray, int]] = []
        for d, k in zip(docs, y, strict=True):
            s = _means(score[d])
            top = int(s.argmax())
            chosen.append((d[top : top + WINDOW], int(k)))
            if not k:
                for a in rng.integers(0, len(s), 2):
                    chosen.append((d[a : a + WINDOW], 0))
        emb, out, bias = _train(chosen, ids, at, emb, out, bias, rng)
        model = Model(emb @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]), 1.0, 0.0)
        score = np.add.reduceat(model.buckets[ids], at[:-1]) / size
    logits = np.array([_worst(_means(_edged(score[d])) + model.bias) for d in docs])
    model.scale, model.shift = temperature(logits, y)
    return model


def _means(s: np.ndarray) -> np.ndarray:
    """The mean of each window of a text's words; the whole text is the one window of a shorter text."""
    if len(s) <= WINDOW:
        return np.array([s.mean() if len(s) else 0.0])
    c = np.concatenate(([0.0], np.cumsum(s)))
    return (c[WINDOW:] - c[:-WINDOW]) / WINDOW


def _edged(s: np.ndarray) -> np.ndarray:
    """With empty places before and behind, so that the first and last words lie in as many windows as others."""
    return np.pad(s, WINDOW - 1) if len(s) > WINDOW else s


def _worst(windows: np.ndarray) -> float:
    """The mean of the WORST greatest."""
    return float(np.sort(windows if len(windows) <= WORST else np.partition(windows, -WORST)[-WORST:]).mean())


def _train(windows, ids, at, emb, out, bias, rng, rate: float = 0.5, batch: int = 64):
    """Adagrad over windows (words, label): embeddings, softmax and bias jointly. A word's n-grams are ids[at[word] : at[word + 1]]."""
    seen_e, seen_o, seen_b = np.full(len(emb), 1e-4), np.full(out.shape, 1e-4), np.full(2, 1e-4)
    weight = len(windows) / 2 / np.maximum(1, np.bincount([y for _, y in windows], minlength=2))
    flat = [np.concatenate([ids[at[w] : at[w + 1]] for w in ws]) for ws, _ in windows]
    # each word's n-grams share the word's part of the window
    part = [np.concatenate([np.full(at[w + 1] - at[w], 1 / (at[w + 1] - at[w]) / len(ws)) for w in ws]) for ws, _ in windows]
    label = np.array([y for _, y in windows])
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for begin in range(0, len(order), batch):
            rows = order[begin : begin + batch]
            here, coef = np.concatenate([flat[k] for k in rows]), np.concatenate([part[k] for k in rows])
            owner = np.repeat(np.arange(len(rows)), [len(flat[k]) for k in rows])
            cuts = np.cumsum([0, *[len(flat[k]) for k in rows]])[:-1]
            mean = np.add.reduceat(emb[here] * coef[:, None], cuts)
            z = mean @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = (p - np.eye(2)[label[rows]]) * weight[label[rows]][:, None] / len(rows)
            g_out, g_mean, g_b = mean.T @ g + 1e-4 * out, g @ out.T, g.sum(0)
            uniq, back = np.unique(here, return_inverse=True)
            total = np.zeros((len(uniq), emb.shape[1]))
            add_rows(total, back, g_mean[owner] * coef[:, None])
            total += 1e-5 * emb[uniq]
            seen_e[uniq] += (total**2).mean(1)
            emb[uniq] -= rate * 0.2 * total / np.sqrt(seen_e[uniq])[:, None]
            seen_o += g_out**2
            out -= rate * 0.2 * g_out / np.sqrt(seen_o)
            seen_b += g_b**2
            bias -= rate * 0.2 * g_b / np.sqrt(seen_b)
    return emb, out, bias


def scored(docs: DataFrame, model: Model | None, carry: tuple[str, ...] = (), name: str = "_score") -> DataFrame:
    """doc_id, the carried columns and `name`, the score (0 to 1), of each row of docs (doc_id, text)."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS doubles: fixed size
    kept = list(dict.fromkeys(["doc_id", *carry]))
    text = "text" if "text" in kept else unused(docs, "_text")  # a carried text travels once

    def forget() -> None:
        if sent.value:
            sent.value.known.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        take_turn("toxicity")
        for batch in batches:
            texts = [t or "" for t in column(batch, text)]
            s = pa.array(m.scores(texts) if m else [0.0] * len(texts), pa.float64())
            own = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*own, s], names=[*kept, name])

    schema = StructType([*(docs.schema[c] for c in kept), StructField(name, DoubleType())])
    sent_columns = kept if text == "text" else [*kept, F.col("text").cast("string").alias(text)]
    return docs.select(*sent_columns).mapInArrow(tidy(run, forget), schema)


def fit_on(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> Model | None:
    """Fit on a sample of the labelled rows outside the held-out fold."""
    model = fit(sample(docs, labels, "toxic", fold(n=folds) != held_out, MOST, MOST_CHARS))
    release()  # the sample and what was made of it
    return model


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs; labels of the held-out fold are not read."""
    model = fit_on(docs, labels)
    return scored(docs, model).select("doc_id", (fold(n=5) == 0).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))
