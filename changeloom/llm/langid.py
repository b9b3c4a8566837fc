"""Language ID by a linear-chain conditional random field over words.

A text's words (runs of letters, in lower case) form one chain, however long the text. A run
of over PIECE letters (text without spaces, long compounds) counts as several words:
consecutive pieces of about equal length. A piece has all n-grams that end in it, those that
begin before its cut too, so no letter and no n-gram is lost; a cut is no word border. A
word's potentials come from hashed features: prefixes and suffixes of one to three letters,
two- and three-letter n-grams with word borders, and the word itself if it is in the lexicon
(frequent words of the sample). Transitions between labels and start weights are learned
with them. Forward-backward gives each word's label probabilities, so texts that switch
languages are labelled word by word; the text's language is the one with the largest mean
probability, and that mean is the score.

Forward-backward works on stretches of STRETCH words at once: a stretch's potentials multiply
to a matrix that carries the messages over it, so the result is that of the whole chain.

Fit, on a bounded sample of rows with a language (at most SAMPLE_ROWS texts and
SAMPLE_BYTES of text for each language, by least hash of the id), in one task: a text's label
stands for each of its words. Training chains are two pieces of at most TRAIN_PIECE words;
all of the sample is in one. Chains of one label would teach no switching, so every other
one is joined from pieces of any two texts. Maximum likelihood by AdaGrad with exact
gradients from forward-backward.

Cases: null texts and texts without letters are `und` with score 0; without any labelled
row all are `und`; languages of equal probability go by code point; equal texts have equal
results; whole texts of any length are labelled, in groups of bounded memory; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SAMPLE_ROWS, SAMPLE_BYTES = 800, 384 << 10
FOLDS, HELD_OUT, UNKNOWN = 3, 1, "und"
#: A word of PIECE letters has at most 17 pairs, 16 triples and 6 affixes, and may be in the lexicon.
PIECE, MOST_FEATURES = 16, 40
ROWS, LEXICON, STRETCH = 1 << 15, 1500, 64
TRAIN_PIECE, BATCH, EPOCHS, RATE, SEED = 12, 64, 2, 0.3, 11
_CACHE, _GROUP, _MATRICES = 500_000, 200_000, 1 << 22
#: A piece starts with the two letters before its cut and _FROM, and ends in _ON if the run goes on.
_WORD, _FROM, _ON = re.compile(r"[^\W\d_]+"), "+", "-"


def _pieces(word: str) -> list[str]:
    """A long run of letters in pieces."""
    n = -(-len(word) // PIECE)
    cuts = [len(word) * i // n for i in range(n + 1)]
    return [(word[cuts[i] - 2 : cuts[i]] + _FROM if i else "") + word[cuts[i] : cuts[i + 1]] + _ON * (i < n - 1) for i in range(n)]


def words_of(text: str | None) -> list[str]:
    words = _WORD.findall((text or "").lower())
    if any(len(w) > PIECE for w in words):
        words = [p for w in words for p in (_pieces(w) if len(w) > PIECE else (w,))]
    return words if any(w.isalpha() or any(map(str.isalpha, w)) for w in words) else []


class _Rows(dict):
    """Row of a feature's name, remembered for a bounded number of names."""

    def __missing__(self, name: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        found = self[name] = zlib.crc32(name.encode()) % ROWS
        return found


_rows = _Rows()


def feature_rows(word: str, lexicon: dict[str, int]) -> list[int]:
    """Rows of a word's features. Row ROWS + k is the k-th lexicon word."""
    before, cut, body = word.rpartition(_FROM)
    own = body.removesuffix(_ON)
    # affixes carry their side; an n-gram at a border carries the border
    names = set() if cut else {"p" + own[:1], "p" + own[:2], "p" + own[:3]}
    marked = (before if cut else "<") + own
    if own is body:
        names |= {"s" + own[-1:], "s" + own[-2:], "s" + own[-3:]}
        marked += ">"
    # the pair before a cut is the piece's before it
    names.update(map("".join, zip(marked[bool(cut) :], marked[bool(cut) + 1 :], strict=False)), map("".join, zip(marked, marked[1:], marked[2:], strict=False)))
    rows = sorted(map(_rows.__getitem__, names))
    return rows + ([ROWS + lexicon[word]] if word in lexicon else [])


def feature_table(words: list[str], lexicon: dict[str, int]) -> np.ndarray:
    """The words' rows, filled up with the row behind the lexicon's last."""
    table = np.full((len(words), MOST_FEATURES), ROWS + len(lexicon), np.int32)
    for i, w in enumerate(words):
        rows = feature_rows(w, lexicon)
        table[i, : len(rows)] = rows
    return table


def _through(vectors: np.ndarray, step: np.ndarray) -> np.ndarray:
    """sum over i of vectors[..., i, :] * step[i, j], as (..., j, :).

    Label by label: a matrix product may round a chain differently by its place in the batch.
    """
    out = vectors[..., 0, None, :] * step[0][:, None]
    for i in range(1, len(step)):
        out += vectors[..., i, None, :] * step[i][:, None]
    return out


def forward_backward(psi: np.ndarray, mask: np.ndarray, step: np.ndarray, entry: np.ndarray, leave: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward weights (length, labels, n) of padded stretches of chains.

    psi: potentials (length, labels, n); mask: (length, n); entry: (labels, n) weights of the
    first word's labels by what comes before; leave: those of the last word's by what follows.
    """
    ahead, back = np.empty_like(psi), np.empty_like(psi)
    now = entry
    for t in range(len(psi)):
        now = (now if t == 0 else _through(now, step)) * psi[t]
        now /= now.sum(0)
        ahead[t] = now
    now = back[-1] = leave
    turned = np.ascontiguousarray(step.T)
    for t in range(len(psi) - 2, -1, -1):
        after = _through(now * psi[t + 1], turned)
        # behind the last word of a stretch there is only what follows it
        now = back[t] = np.where(mask[t + 1], after / after.sum(0), leave)
    return ahead, back


def _carried(psi: np.ndarray, mask: np.ndarray, step: np.ndarray) -> np.ndarray:
    """(labels, labels, n): weight of a stretch's last label for each first one, its potentials within."""
    langs, n = psi.shape[1:]
    out = np.zeros((langs, langs, n))
    out[np.arange(langs), np.arange(langs)] = psi[0]
    for t in range(1, len(psi)):
        more = _through(out, step) * psi[t]
        more /= more.max((0, 1))
        out = np.where(mask[t], more, out)
    return out


def whole_chains(scores: np.ndarray, sizes: list[int], step: np.ndarray, entry: np.ndarray, leave: np.ndarray) -> np.ndarray:
    """Label probabilities (words, labels) of chains one after another, `sizes` words each.

    scores: (words, labels) logarithms of potentials; entry, leave: weights before the first
    and behind the last word of each chain (chains, labels). All of a chain counts for each word.
    """
    langs = scores.shape[1]
    firsts = np.concatenate([np.arange(0, n, STRETCH) + base for n, base in zip(sizes, np.cumsum([0, *sizes[:-1]]).tolist(), strict=True)])
    counts = -(-np.array(sizes) // STRETCH)
    begin = np.cumsum(counts) - counts
    lengths = np.minimum(STRETCH, np.repeat(np.cumsum(sizes), counts) - firsts)
    place = firsts[:, None] + np.arange(STRETCH)
    mask = np.arange(STRETCH) < lengths[:, None]
    psi = np.exp(scores - scores.max(1, keepdims=True))[np.where(mask, place, 0)]
    psi[~mask] = 1.0
    psi, mask_t = np.ascontiguousarray(psi.transpose(1, 2, 0)), np.ascontiguousarray(mask.T)
    into, out = np.empty((langs, len(firsts))), np.empty((langs, len(firsts)))
    into[:, begin], out[:, begin + counts - 1] = entry.T, leave.T
    # messages between stretches, of all chains with so many at once
    several = np.flatnonzero(np.repeat(counts, counts) > 1)
    if len(several):
        carried = np.empty((langs, langs, len(firsts)))
        most = max(1, _MATRICES // langs**2)
        for at in range(0, len(several), most):
            which = several[at : at + most]
            carried[:, :, which] = _carried(psi[:, :, which], mask_t[:, which], step)
        turned = np.ascontiguousarray(step.T)
        for k in range(1, int(counts.max())):
            here = (begin + k)[counts > k]
            now = _through((into[:, None, here - 1] * carried[:, :, here - 1]).sum(0), step)
            into[:, here] = now / now.sum(0)
        for k in range(1, int(counts.max())):
            here = (begin + counts - 1 - k)[counts > k]
            now = _through((carried[:, :, here + 1] * out[None, :, here + 1]).sum(1), turned)
            out[:, here] = now / now.sum(0)
    ahead, back = forward_backward(psi, mask_t, step, into, out)
    both = ahead * back
    both /= both.sum(1, keepdims=True)
    return both.transpose(2, 0, 1)[mask]


def train(sample: Iterable[tuple[str, str]]) -> dict:
    """A model from (text, language)."""
    sample = list(sample)
    langs = sorted({lang for _, lang in sample})
    texts = [(words_of(t), langs.index(lang)) for t, lang in sample]
    texts = [(w, k) for w, k in texts if w]
    if not texts:
        return {"langs": []}
    langs_n = len(langs)
    seen = [Counter() for _ in langs]
    for words, k in texts:
        seen[k].update(words)
    frequent = sorted({w for c in seen for w, _ in sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:LEXICON]})
    lexicon = {w: i for i, w in enumerate(frequent)}
    pad = ROWS + len(lexicon)
    rng = np.random.default_rng(SEED)
    names = sorted({w for words, _ in texts for w in words})
    number = {w: i for i, w in enumerate(names)}
    table = feature_table(names, lexicon)
    norm = 1 / np.sqrt((table < pad).sum(1, keepdims=True))
    # pieces in order; a chain is two of them: neighbours, or for every other chain any two
    pieces = [([number[w] for w in words[at : at + TRAIN_PIECE]], k) for words, k in texts for at in range(0, len(words), TRAIN_PIECE)]
    pairs = [pieces[i : i + 2] for i in range(0, len(pieces), 2)]
    mixed = [p for pair in pairs[1::2] for p in pair]
    mixed = [mixed[i] for i in rng.permutation(len(mixed))]
    pairs = pairs[::2] + [mixed[i : i + 2] for i in range(0, len(mixed), 2)]
    width = 2 * TRAIN_PIECE
    word_ids, gold, mask = np.zeros((len(pairs), width), np.int64), np.zeros((len(pairs), width), np.int64), np.zeros((len(pairs), width), bool)
    for i, pair in enumerate(pairs):
        words, labels = [w for own, _ in pair for w in own], [k for own, k in pair for _ in own]
        word_ids[i, : len(words)], gold[i, : len(words)], mask[i, : len(words)] = words, labels, True
    weights, start, trans = np.zeros((pad + 1, langs_n)), np.zeros(langs_n), np.zeros((langs_n, langs_n))
    squares = [np.full_like(w, 1e-3) for w in (weights, start, trans)]
    one = np.eye(langs_n)
    for _ in range(EPOCHS):
        order = rng.permutation(len(pairs))
        for at in range(0, len(order), BATCH):
            i = order[at : at + BATCH]
            m, y = mask[i], one[gold[i]]
            used, back_to = np.unique(word_ids[i], return_inverse=True)
            scores = (weights[table[used]].sum(1) * norm[used])[back_to.reshape(word_ids[i].shape)] * m[..., None]
            psi = np.exp(scores - scores.max(2, keepdims=True)).transpose(1, 2, 0)
            step = np.exp(trans - trans.max())
            entry = np.repeat(np.exp(start - start.max())[:, None], len(i), 1)
            ahead, back = forward_backward(psi, m.T, step, entry, np.ones_like(entry))
            ahead, back = ahead.transpose(2, 0, 1), (psi * back).transpose(2, 0, 1)
            p = ahead * back / psi.transpose(2, 0, 1)
            error = (p / p.sum(2, keepdims=True) - y) * m[..., None]
            per_word = np.zeros((len(used), langs_n))
            np.add.at(per_word, back_to.ravel(), error.reshape(-1, langs_n))
            rows, inverse = np.unique(table[used], return_inverse=True)
            g_rows = np.zeros((len(rows), langs_n))
            np.add.at(g_rows, inverse.ravel(), np.repeat(per_word * norm[used], MOST_FEATURES, 0))
            g_rows[rows == pad] = 0
            joint = ahead[:, :-1, :, None] * step * back[:, 1:, None, :]
            joint /= joint.sum((2, 3), keepdims=True)
            g_trans = ((joint - y[:, :-1, :, None] * y[:, 1:, None, :]) * m[:, 1:, None, None]).sum((0, 1))
            g_start = error[:, 0].sum(0)
            n = len(i)
            for w, s, where, g in ((weights, squares[0], rows, g_rows / n), (start, squares[1], slice(None), g_start / n), (trans, squares[2], slice(None), g_trans / n)):
                s[where] += g * g
                w[where] -= RATE * g / np.sqrt(s[where])
    return {"langs": langs, "lexicon": lexicon, "weights": weights, "start": np.exp(start - start.max()), "step": np.exp(trans - trans.max())}


class Labeller:
    """Word probabilities of texts; potentials are remembered for a bounded number of words."""

    def __init__(self, model: dict):
        self.model, self.known = model, {}
        self.potentials = np.empty((0, len(model["langs"])))

    def _scores(self, words: list[str]) -> np.ndarray:
        if len(self.known) > _CACHE:
            self.known, self.potentials = {}, self.potentials[:0]
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            weights, lexicon = self.model["weights"], self.model["lexicon"]
            found = np.empty((len(new), len(self.model["langs"])))
            for at in range(0, len(new), 4096):
                table = feature_table(new[at : at + 4096], lexicon)
                found[at : at + 4096] = weights[table].sum(1) / np.sqrt((table < len(weights) - 1).sum(1, keepdims=True))
            self.known |= {w: i for i, w in enumerate(new, len(self.known))}
            self.potentials = np.concatenate([self.potentials, found])
        return self.potentials[np.array([self.known[w] for w in words], np.int64)]

    def group_words(self) -> int:
        """Words that are worked at once: so that matrices of many languages stay bounded."""
        return max(STRETCH, min(_GROUP, STRETCH * (_MATRICES // len(self.model["langs"]) ** 2)) // STRETCH * STRETCH)

    def probabilities(self, texts: list[list[str]]) -> list[np.ndarray]:
        """(words, labels) of each text; texts that are one group together, or one text of any length."""
        step, start, most = self.model["step"], self.model["start"], self.group_words()
        ones = np.ones((len(texts), len(start)))
        sizes = [len(words) for words in texts]
        if sum(sizes) <= most or len(texts) > 1:
            found = whole_chains(self._scores([w for words in texts for w in words]), sizes, step, ones * start, ones)
            return np.split(found, np.cumsum(sizes)[:-1])
        # parts of a long text: messages go over all of them, first forward, then back
        parts = [texts[0][at : at + most] for at in range(0, sizes[0], most)]
        into, out, found = [start], ones[0], []

        def psi_of(part: list[str]) -> np.ndarray:
            scores = self._scores(part)
            return np.exp(scores - scores.max(1, keepdims=True))

        for part in parts[:-1]:
            now = into[-1][:, None]
            for t, psi in enumerate(psi_of(part)):
                now = (now if t == 0 else _through(now, step)) * psi[:, None]
                now /= now.sum()
            now = _through(now, step)
            into.append((now / now.sum())[:, 0])
        for part, entry in zip(parts[::-1], into[::-1], strict=True):
            scores = self._scores(part)
            found.append(whole_chains(scores, [len(part)], step, entry[None], out[None]))
            # what the part before has to know: the first word's weights by what comes from it on
            first = found[-1][0] / np.maximum(entry, 1e-300)
            out = _through(first[:, None], np.ascontiguousarray(step.T))[:, 0]
            out /= out.sum()
        return [np.concatenate(found[::-1])]

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[dict]]]:
        """(language, score, runs of equally labelled words) of each text."""
        langs = self.model["langs"]
        out: list = [(UNKNOWN, 0.0, [])] * len(texts)
        if not langs:
            return out
        held: list[tuple[int, list[str]]] = []

        def finish() -> None:
            if held:
                for (i, _), p in zip(held, self.probabilities([w for _, w in held]), strict=True):
                    mean = p.mean(0)
                    best = p.argmax(1)
                    cuts = np.flatnonzero(np.diff(best)) + 1
                    runs = [{"first": int(a), "last": int(b) - 1, "lang": langs[best[a]]} for a, b in zip([0, *cuts], [*cuts, len(best)], strict=True)]
                    out[i] = langs[int(mean.argmax())], float(mean.max()), runs
                held.clear()

        load, most = 0, self.group_words()
        for i, text in enumerate(texts):
            words = words_of(text)
            if not words:
                continue
            if load + len(words) > most:
                finish()
                load = 0
            held.append((i, words))
            load += len(words)
        finish()
        return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS, bytes_: int = SAMPLE_BYTES, most_langs: int = common.MOST_LABELS) -> dict:
    """Learn only from rows with a language outside the held-out fold; over `most_langs` languages are an error."""
    learn = (common.fold_of(F.col(id_col), FOLDS) != HELD_OUT) & F.col(lang_col).isNotNull()
    sample = common.bounded_sample(docs, learn, F.col(lang_col), rows, bytes_, id_col, text_col, most_labels=most_langs)
    return common.train_in_task(sample, train, bytes_)


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, runs: words `first` to `last` of one label, for every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        labeller = Labeller(held.value)

        def work(texts):
            import pyarrow as pa

            found = labeller.label(texts)
            run = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())])
            return [f[0] for f in found], pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.list_(run))

        return work

    return common.apply_batches(docs, id_col, text_col, "lang_pred string, score double, runs array<struct<first:int,last:int,lang:string>>", make)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: the language of every whole text of documents."""
    docs = common.read_table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select(
        "doc_id",
        (common.fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "lang_pred",
        "score",
        F.size("runs").cast("long").alias("n_runs"),
    )
