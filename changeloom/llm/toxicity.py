"""Toxicity by compression distance.

Fit, on a bounded sample of labelled rows (at most SAMPLE_ROWS texts and SAMPLE_BYTES of
text for each label, by least hash of the id; 60 % of it for dictionaries, 40 % for
calibration), in one task:

* The ordinary dictionary is trained by zstandard on windows of ordinary text, the toxic one
  on windows of toxic text; they share nothing.
* A text marked toxic is mostly ordinary. So the toxic dictionary is trained in ROUNDS: the
  first time on windows of whole toxic texts, then on those that it compresses better than
  the ordinary dictionary by a margin which windows of toxic texts reach MARGIN_RATIO times
  as often as windows of other ordinary texts. Toxic texts go in two halves, and a half's
  windows are chosen by the dictionary of the other, which has not seen them.
* Calibration: thresholds on gains, by logistic regression on how many windows reach each.

Score: the text's words, in lower case, go in windows of each of WINDOWS words. A window is
compressed with either dictionary; its gain is the length under the ordinary one less that
under the toxic one. The counts of windows that reach each of THRESHOLDS, and each of SHARES
of their length, as numbers and as shares, the mean and the largest gain, for each size of
window, give the score by the calibrated weights. Windows are spelled in two bytes a letter, so that a letter costs more
against a match's fixed cost. A constant carrier stands on either side of a window, as
zstandard looks for no match in the last bytes of a frame and stores short frames raw.

Cases: null and empty texts have no windows and score as texts whose only window gains 0;
without labelled rows of both kinds every score is their share of toxic ones (0 without
any). Whole texts of any length are scored, window by window; equal texts have equal
scores; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SAMPLE_ROWS, SAMPLE_BYTES = 2500, 8 << 20
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
ENCODING, SEPARATOR, CARRIER = "utf-16-le", " ", b"." * 32
STRATEGY, SEARCH_LOG, LOGS, MIN_MATCH = "STRATEGY_LAZY", 2, 16, 6
#: Words of a window when texts are scored, and when dictionaries are trained (there each word starts one).
WINDOWS, TRAIN_WORDS = (1, 8), 2
DICTIONARY_BYTES, TRAIN_WINDOWS, COVER, ROUNDS, MARGIN_RATIO = 110 << 10, 120_000, {"k": 2000, "d": 8}, 4, 8.0
#: Gains in bytes, and in tenths of the window's length less _FRAME bytes of what any window takes.
THRESHOLDS, SHARES, _FRAME = (2, 3, 4, 5, 6, 8, 10, 12, 16), (2, 3, 4, 5, 6), 14
_CACHE, _CALL, _GROUP = 300_000, 4096, 1 << 20
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def windows_of(words: list[str], size: int, step: int) -> list[str]:
    """Windows of `size` words, one starting every `step`; the last may be shorter."""
    if size == 1:
        return words
    return [SEPARATOR.join(words[i : i + size]) for i in range(0, max(len(words) - size + step, 1), step)] if words else []


def _spelled(window: str) -> bytes:
    return f"{SEPARATOR}{window}{SEPARATOR}".encode(ENCODING)


def train_dictionary(windows: list[str], size: int = DICTIONARY_BYTES) -> bytes:
    """zstandard's dictionary of at most TRAIN_WINDOWS of the windows, evenly drawn; of at most
    half their size."""
    import zstandard

    drawn = [_spelled(windows[i * len(windows) // TRAIN_WINDOWS]) for i in range(TRAIN_WINDOWS)] if len(windows) > TRAIN_WINDOWS else list(map(_spelled, windows))
    size = min(size, sum(map(len, drawn)) // 2)
    try:
        return zstandard.train_dictionary(max(size, 256), drawn, **COVER).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        return b"".join(drawn)[: max(size, 256)]


class Lengths:
    """Compressed lengths of windows with each of some dictionaries, many windows a call."""

    def __init__(self, *contents: bytes):
        import zstandard

        settings = zstandard.ZstdCompressionParameters(
            window_log=18, chain_log=LOGS, hash_log=LOGS, search_log=SEARCH_LOG, min_match=MIN_MATCH, target_length=64,
            strategy=getattr(zstandard, STRATEGY), write_content_size=False, write_dict_id=False,
        )
        self._segments, self._compress = zstandard.BufferWithSegments, []
        for content in contents:
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=settings)
            self._compress.append(zstandard.ZstdCompressor(dict_data=held, compression_params=settings).multi_compress_to_buffer)

    def of(self, windows: list[str]) -> np.ndarray:
        """(dictionaries, windows)"""
        out = np.empty((len(self._compress), len(windows)), np.int64)
        before, behind = CARRIER.decode(ENCODING) + SEPARATOR, SEPARATOR + CARRIER.decode(ENCODING)
        for at in range(0, len(windows), _CALL):
            part = windows[at : at + _CALL]
            framed = (before + (behind + before).join(part) + behind).encode(ENCODING)
            sizes = 2 * (np.fromiter(map(len, part), np.int64, len(part)) + len(before) + len(behind))
            if sizes.sum() != len(framed):  # letters of four bytes
                sizes = np.array([len(w.encode(ENCODING)) for w in part]) + 2 * (len(before) + len(behind))
            ends = np.cumsum(sizes)
            pieces = self._segments(framed, np.stack([ends - sizes, sizes], 1).astype("<u8").tobytes())
            for k, compress in enumerate(self._compress):
                out[k, at : at + len(part)] = [len(frame) for frame in compress(pieces)]
        return out


class Scorer:
    """Gains of windows under two dictionaries, and the calibrated score of a text."""

    def __init__(self, model: dict):
        self.model = model
        if "toxic" in model:
            self.lengths = Lengths(model["ordinary"], model["toxic"])
        #: Both lengths of words, of which texts repeat many: a bounded number of them.
        self.known: dict[str, int] = {}

    def _both(self, windows: list[str]) -> list[int]:
        """The length under the ordinary dictionary << 32 and under the toxic one."""
        plain, toxic = self.lengths.of(windows)
        return (plain << 32 | toxic).tolist()

    def _of_words(self, texts: list[list[str]]) -> list[np.ndarray]:
        every = dict.fromkeys(w for words in texts for w in words)
        new = [w for w in every if w not in self.known]
        if len(self.known) + len(new) > _CACHE:
            self.known, new = {}, list(every)
        self.known.update(zip(new, self._both(new), strict=True))
        return [np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)) for words in texts]

    def _of_windows(self, texts: list[list[str]], size: int) -> list[np.ndarray]:
        cut = [windows_of(words, size, size) for words in texts]
        both = np.array(self._both([w for own in cut for w in own]), np.int64)
        return np.split(both, np.cumsum([len(own) for own in cut])[:-1])

    def features(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Of texts given as their words."""
        found = [self._of_words(texts) if size == 1 else self._of_windows(texts, size) for size in WINDOWS]
        return [np.concatenate([part for own in each for part in _counts(own)]) for each in zip(*found, strict=True)]

    def scores(self, texts: list[str | None]) -> list[float]:
        if "weights" not in self.model:
            return [self.model["share"]] * len(texts)
        out: list[float] = []
        held: list[list[str]] = []
        load = 0
        for i, text in enumerate(texts):
            held.append(words_of(text))
            load += len(text or "")
            if load >= _GROUP or i == len(texts) - 1:
                for x in self.features(held):
                    z = (x - self.model["mean"]) / self.model["scale"]
                    out.append(float(1 / (1 + math.exp(-max(-500.0, min(500.0, float(z @ self.model["weights"][:-1] + self.model["weights"][-1])))))))
                held, load = [], 0
        return out

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]


def _counts(both: np.ndarray) -> list:
    """How many windows of a text gain how much."""
    both = both if len(both) else np.zeros(1, np.int64)
    plain = both >> 32
    gains = plain - (both & 0xFFFFFFFF)
    tenths = np.minimum(10 * gains // np.maximum(plain - _FRAME, 1), 10)[gains >= THRESHOLDS[0]]
    at_least = lambda values, top: np.bincount(np.maximum(values, 0), minlength=top + 1)[::-1].cumsum()[::-1]
    over = np.concatenate([at_least(np.minimum(gains, 32), 32)[list(THRESHOLDS)], at_least(tenths, 10)[list(SHARES)]]).astype(float)
    return [np.log1p(over), np.sqrt(over / len(gains)), [math.log1p(len(gains)), gains.mean(), min(int(gains.max()), 32) / 10]]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    pull = np.r_[np.full(len(w) - 1, ridge), 1e-6]
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-6), x.T @ (weight * (p - y)) + pull * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _margin(toxic: np.ndarray, ordinary: np.ndarray) -> int | None:
    """The least gain that windows of toxic texts reach MARGIN_RATIO times as often as ordinary ones do."""
    for least in range(1, int(toxic.max(initial=0)) + 1):
        a, b = np.count_nonzero(toxic >= least), np.count_nonzero(ordinary >= least)
        if a * (len(ordinary) + 1) >= MARGIN_RATIO * (b + 1) * len(toxic):
            return least
    return None


def dictionaries(toxic: list[list[str]], ordinary: list[list[str]]) -> tuple[bytes, bytes]:
    """The two dictionaries from the words of toxic and of ordinary texts."""
    cut = lambda texts: [w for words in texts for w in windows_of(words, TRAIN_WORDS, 1)]
    plain = train_dictionary(cut(ordinary[::2]))
    others = cut(ordinary[1::2] or ordinary)
    others = others[:: max(1, len(others) // (2 * TRAIN_WINDOWS))]
    halves = [cut(toxic[::2]), cut(toxic[1::2] or toxic)]
    chosen = halves
    for _ in range(ROUNDS):
        found = []
        for own, seen in zip(halves, chosen[::-1], strict=True):
            lengths = Lengths(plain, train_dictionary(seen))
            gains, others_gains = (a - b for a, b in map(lengths.of, (own, others)))
            least = _margin(gains, others_gains)
            found.append([w for w, g in zip(own, gains.tolist(), strict=True) if g >= least] if least else [])
        if not all(found):
            break  # nothing stands out: the last choice stays
        chosen = found
    return train_dictionary(chosen[0] + chosen[1]), plain


def train(sample: Iterable[tuple[str, int]], share: float) -> dict:
    """A model from (text, label); `share` is that of label 1 among all rows to learn from."""
    texts: dict[int, list[list[str]]] = {0: [], 1: []}
    for text, label in sample:
        if words := words_of(text):
            texts[label].append(words)
    cut = {k: -(-len(own) * 3 // 5) for k, own in texts.items()}
    if min(len(own) - cut[k] for k, own in texts.items()) < 1:
        return {"share": share}
    toxic, ordinary = dictionaries(texts[1][: cut[1]], texts[0][: cut[0]])
    model = {"share": share, "toxic": toxic, "ordinary": ordinary}
    scorer = Scorer(model)
    rest = [(words, k) for k in (1, 0) for words in texts[k][cut[k] :]]
    x = np.concatenate([scorer.features([words for words, _ in rest[at : at + 100]]) for at in range(0, len(rest), 100)])
    y = np.array([k for _, k in rest], float)
    # the sample has each label to its own bound; weights bring back the true share
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    mean, scale = x.mean(0), x.std(0) + 1e-6
    return model | {"mean": mean, "scale": scale, "weights": _logistic((x - mean) / scale, y, weight)}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = SAMPLE_ROWS, bytes_: int = SAMPLE_BYTES) -> dict:
    """Learn only from rows outside the held-out fold."""
    learn = common.fold_of(F.col(id_col), FOLDS) != HELD_OUT
    label = F.col(label_col).cast("int")
    share = labels.filter(learn & label.isin(0, 1)).agg(F.avg(label.cast("double")).alias("share")).first().share or 0.0
    sample = common.bounded_sample(docs, learn & label.isin(0, 1), label, rows, bytes_, id_col, text_col, labels)
    return common.train_in_task(sample, lambda texts: train(texts, share), bytes_)


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(held.value)
        return lambda texts: [scorer.scores(texts)]

    return common.apply_batches(docs, id_col, text_col, "score double", make)


def keep_clean(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score stays under the threshold, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(held.value)
        return lambda texts: [s < threshold for s in scorer.scores(texts)]

    return common.keep_rows(docs, text_col, make)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: toxicity of every whole text of documents."""
    docs = common.read_table(spark, sf_dir, "documents")
    model = fit(docs, common.read_table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        (common.fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
