"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Fit, on a bounded sample of labelled rows (at most SAMPLE_ROWS texts and SAMPLE_BYTES of
text for each label, by least hash of the id), in one task:

* A token counts as two words: itself in lower case without outer punctuation, and its
  shape (letter case, digits, punctuation; runs shortened). Each word has one of ROWS rows
  by its hash, so the table of word vectors has a fixed size; words that share a row share
  a vector, and with more than ROWS distinct words many do.
* Random indexing: a row has a sparse ternary index vector of WIDTH places drawn from its
  number, and its word vector is the sum of the index vectors of the words within
  CONTEXT tokens of its occurrences, brought to length 1.
* Pooling: mean vector of the words, mean vector of the shapes, mean of the products of
  neighbours' vectors by place, and how alike and how often equal neighbours are, how many
  tokens are distinct, and the length.
* A network with one hidden layer of HIDDEN units (tanh), trained by Adam with weights that
  bring back the labels' true shares; a fifth of the sample is kept back and gives the
  temperature that divides the logit.

Cases: null and empty texts pool to zeros and are scored so; without labelled rows of both
kinds every score is their share of label 1 (0.5 without any). Whole texts of any length
are scored; equal texts have equal scores; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SAMPLE_ROWS, SAMPLE_BYTES = 2500, 10 << 20
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
ROWS, WIDTH, NONZERO, CONTEXT, HIDDEN, SEED = 1 << 14, 64, 6, 2, 32, 7
EPOCHS, BATCH, RATE, DECAY = 60, 64, 2e-3, 1e-3
_CACHE = 200_000


def _shape(token: str) -> str:
    out: list[str] = []
    for c in token:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if out[-2:] != [kind, kind]:
            out.append(kind)
    return "".join(out)


def _row(word: str) -> int:
    return zlib.crc32(word.encode()) % ROWS


class Tokens(dict):
    """token -> (row of the word, row of its shape), remembered for a bounded number of tokens."""

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) >= _CACHE:
            self.clear()
        bare = token.strip("".join({c for c in token if not c.isalnum()})) or token
        found = self[token] = _row("w" + bare.lower()), _row("s" + _shape(token))
        return found

    def rows(self, text: str | None) -> np.ndarray:
        found = [self[t] for t in (text or "").split()]
        return np.array(found, np.int64).reshape(-1, 2)


def index_vectors() -> np.ndarray:
    """A sparse ternary vector for each row: NONZERO places, half of them -1."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((ROWS, WIDTH), np.float32)
    places = np.argsort(rng.random((ROWS, WIDTH)), axis=1)[:, :NONZERO]
    out[np.arange(ROWS)[:, None], places] = np.where(np.arange(NONZERO) % 2, -1, 1)
    return out


def word_vectors(rows: list[np.ndarray]) -> np.ndarray:
    """Random indexing over the sample's token rows."""
    index = index_vectors()
    out = np.zeros((ROWS, WIDTH), np.float32)
    for own in rows:
        if len(own) < 2:
            continue
        each = index[own[:, 0]] + index[own[:, 1]]
        context = np.zeros_like(each)
        for k in range(1, min(CONTEXT, len(own) - 1) + 1):
            context[k:] += each[:-k]
            context[:-k] += each[k:]
        np.add.at(out, own[:, 0], context)
        np.add.at(out, own[:, 1], context)
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, length, out=np.zeros_like(out), where=length > 0)


def pool(own: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The document vector of one text's token rows."""
    out = np.zeros(3 * WIDTH + 4, np.float32)
    if not len(own):
        return out
    # in runs, so that a long text needs no more memory than a short one
    words, shapes, products, alike = np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(WIDTH), 0.0
    for at in range(0, len(own), 8192):
        part = own[at : at + 8193]
        v = vectors[part[:, 0]]
        words += v[:8192].sum(0)
        shapes += vectors[part[:8192, 1]].sum(0)
        p = v[1:] * v[:-1]
        products += p.sum(0)
        alike += float(p.sum())
    n, pairs = len(own), max(len(own) - 1, 1)
    out[:WIDTH], out[WIDTH : 2 * WIDTH], out[2 * WIDTH : 3 * WIDTH] = words / n, shapes / n, products / pairs
    out[3 * WIDTH :] = alike / pairs, (own[1:, 0] == own[:-1, 0]).mean() if n > 1 else 0.0, len(np.unique(own[:, 0])) / n, np.log1p(n) / 10
    return out


def _forward(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ model["w1"] + model["b1"])
    return hidden, hidden @ model["w2"] + model["b2"]


def train(sample: Iterable[tuple[str, int]], share: float) -> dict:
    """A model from (text, label); `share` is that of label 1 among all rows to learn from."""
    tokens = Tokens()
    coded = [(tokens.rows(t).astype(np.int32), k) for t, k in sample]
    rows, y = [own for own, _ in coded], np.array([k for _, k in coded], np.float64)
    if len(set(y.tolist())) < 2:
        return {"share": share}
    vectors = word_vectors(rows)
    x = np.array([pool(own, vectors) for own in rows], np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-4
    x = (x - mean) / scale
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    kept_back, learn = order[: len(y) // 5], order[len(y) // 5 :]
    model = {"w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.zeros(())}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    step = 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(learn)
        for at in range(0, len(learn), BATCH):
            i = shuffled[at : at + BATCH]
            hidden, logit = _forward(model, x[i])
            error = weight[i] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[i]) / len(i)
            back = np.outer(error, model["w2"]) * (1 - hidden**2)
            grads = {"w1": x[i].T @ back + DECAY * model["w1"], "b1": back.sum(0), "w2": hidden.T @ error + DECAY * model["w2"], "b2": error.sum()}
            step += 1
            for k, g in grads.items():
                m, v = moments[k]
                m = 0.9 * m + 0.1 * g
                v = 0.999 * v + 0.001 * g * g
                moments[k] = m, v
                model[k] = model[k] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    logit = _forward(model, x[kept_back])[1] if len(kept_back) else np.zeros(0)

    def loss(t: float) -> float:
        p = 1 / (1 + np.exp(-np.clip(logit / t, -30, 30)))
        return float(-(weight[kept_back] * (y[kept_back] * np.log(p + 1e-12) + (1 - y[kept_back]) * np.log(1 - p + 1e-12))).sum())

    temperature = min(np.exp(np.linspace(np.log(0.25), np.log(8), 121)), key=loss) if len(kept_back) else 1.0
    return model | {"share": share, "vectors": vectors, "mean": mean, "scale": scale, "temperature": float(temperature)}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = SAMPLE_ROWS, bytes_: int = SAMPLE_BYTES) -> dict:
    """Learn only from rows outside the held-out fold."""
    learn = common.fold_of(F.col(id_col), FOLDS) != HELD_OUT
    label = F.col(label_col).cast("int")
    share = labels.filter(learn & label.isin(0, 1)).agg(F.avg(label.cast("double")).alias("share")).first().share
    share = 0.5 if share is None else share
    sample = common.bounded_sample(docs, learn & label.isin(0, 1), label, rows, bytes_, id_col, text_col, labels)
    return common.train_in_task(sample, lambda texts: train(texts, share), bytes_)


def score_texts(model: dict, texts: list[str | None], tokens: Tokens) -> list[float]:
    if "w1" not in model:
        return [model["share"]] * len(texts)
    if not texts:
        return []
    x = (np.array([pool(tokens.rows(t), model["vectors"]) for t in texts], np.float64) - model["mean"]) / model["scale"]
    # row by row: a product over many rows may round a row differently by its place
    logit = np.array([float(_forward(model, row)[1]) for row in x]) / model["temperature"]
    return (1 / (1 + np.exp(-np.clip(logit, -500, 500)))).tolist()


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        tokens = Tokens()
        return lambda texts: [score_texts(held.value, texts, tokens)]

    return common.apply_batches(docs, id_col, text_col, "score double", make)


def keep_good(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        tokens = Tokens()
        return lambda texts: [s >= threshold for s in score_texts(held.value, texts, tokens)]

    return common.keep_rows(docs, text_col, make)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: quality of every whole text of documents."""
    docs = common.read_table(spark, sf_dir, "documents")
    model = fit(docs, common.read_table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        (common.fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
