"""Toxic spans by a linear-chain conditional random field.

Tags are O and T.  A word emits for T a bias and the weights of its features:
the lowered word and its prefixes of 3 to 7 characters, as far as training
ties them to toxic documents; words without any are background and emit the
bias.  Four transition weights join neighbours.  Forward-backward gives each
word's marginal probability of T; runs of background words are passed by
powers of one matrix.  Spans are runs of words over one half.  A document's
score is a logistic function of its marginals: the expected number of toxic
words, the same relative to the length, and the largest marginal.

Training: labels are per document, so words get their tags from them first.
In documents labelled toxic, a word is T when one of its features is tied to
toxic documents (a lower confidence bound of its log odds ratio is over
``MIN_ODDS``); every other word is O.  The field is trained on one half of the
sample by gradient ascent of its likelihood, the logistic function on the
other half, weighted to the class shares among all learning labels.  The
sample is bounded: at most ``MAX_PER_CLASS`` documents per class, those of
least id hash, of at most ``MAX_CHARS`` characters each; sample and model
(at most ``MAX_FEATURES`` weights) have a fixed size whatever the input, so one
task fits and the model travels to all tasks.  Scoring reads whole texts.

Defined cases: null text is empty and gets the score of a document without
words; null ids are never held out; contradicting labels count as toxic; null
labels are not used; without labels of both classes every score is the share
of toxic labels (zero without any).  Repeated rows each get a row; an empty
table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.llm.byte_bpe import Numbering

MAX_PER_CLASS = 2000
MAX_CHARS = 60_000
MAX_FEATURES = 40_000
MIN_ODDS = 1.5
CHUNK = 256
STEPS = 60
RATE = 0.3
RIDGE = 2e-3
CELLS = 2_000_000
CACHE = 500_000
RUN = 400
THRESHOLD = 0.3
_EDGE = ".,;:!?\"'()[]{}<>%&$*#|-_=+"
_WORD = re.compile(r"\S+")


def word_features(word: str) -> list[str]:
    w = word.lower().strip(_EDGE)
    return [f"w:{w}", *(f"p:{w[:k]}" for k in range(3, 8) if len(w) > k)]


def forward_backward(emit: np.ndarray, size: np.ndarray, weights: np.ndarray, pairs: bool = False):
    """Marginals of T, and the expected counts of the four transitions.

    emit: (time, sequences) with sizes in descending order; weights: log
    weights [[OO, OT], [TO, TT]].  Probabilities are rescaled at each step.
    """
    (oo, ot), (to, tt) = np.exp(weights)
    phi = np.exp(np.clip(emit, -30, 30))
    live = np.searchsorted(-size, -np.arange(len(emit)), "left")  # sequences longer than t
    first = np.zeros(emit.shape)  # share of T in the forward vector
    for t in range(len(emit)):
        n = live[t]
        if t == 0:
            o, x = np.ones(n), phi[0, :n]
        else:
            a = first[t - 1, :n]
            o, x = (1 - a) * oo + a * to, ((1 - a) * ot + a * tt) * phi[t, :n]
        first[t, :n] = x / (o + x)
    share = np.zeros(emit.shape)
    back = np.full(emit.shape[1], 0.5)  # share of T in the backward vector
    counts = np.zeros((2, 2))
    for t in range(len(emit) - 1, -1, -1):
        n = live[t]
        a, b = first[t, :n], back[:n]
        x = a * b
        share[t, :n] = x / (x + (1 - a) * (1 - b))
        if t:
            go, gx = 1 - b, phi[t, :n] * b
            if pairs:
                a = first[t - 1, :n]
                e = np.array([[(1 - a) * oo * go, (1 - a) * ot * gx], [a * to * go, a * tt * gx]])
                counts += (e / e.sum((0, 1))).sum(2)
            o, x = oo * go + ot * gx, to * go + tt * gx
            back[:n] = x / (o + x)
    return share, counts


def _by_time(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(time-major matrix, sizes, order), longest sequence first."""
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    order = np.argsort(-size, kind="stable")
    out = np.zeros((int(size.max()), len(rows)), rows[0].dtype)
    for k, i in enumerate(order):
        out[: size[i], k] = rows[i]
    return out, size[order], order


def document_measures(share: np.ndarray, words: int) -> list[float]:
    """Measures of one document's marginals."""
    total = float(share.sum())
    return [1.0, np.log1p(total), np.log1p(1000 * total / (words + 50)), float(share.max()) if len(share) else 0.0]


def active_marginals(emit, gap, tail, size, bias: float, weights: np.ndarray) -> np.ndarray:
    """Marginals of T of the words that have features.

    emit: (time, sequences), longest first; gap: background words before each
    word; tail: background words after the last.  A run of background words
    multiplies by a power of one 2 x 2 matrix; powers over ``RUN`` don't
    differ from that one, so the result is that of the whole sequence.
    """
    move, own = np.exp(weights), np.diag([1.0, np.exp(np.clip(bias, -30, 30))])
    power, powers = np.eye(2), []
    for _ in range(RUN + 1):
        powers.append(power / power.sum())
        power = powers[-1] @ own @ move
    powers = np.array(powers)  # (own move)^g
    between = move @ powers
    start = powers.sum(1)
    ends = [np.ones(2) / 2]
    for _ in range(RUN):
        end = move @ own @ ends[-1]
        ends.append(end / end.sum())
    ends = np.array(ends)
    phi = np.exp(np.clip(emit, -30, 30))
    gap, tail = np.minimum(gap, RUN), np.minimum(tail, RUN)
    live = np.searchsorted(-size, -np.arange(len(emit)), "left")
    first = np.zeros(emit.shape)
    for t in range(len(emit)):
        n = live[t]
        if t == 0:
            v = start[gap[0]]
        else:
            a, w = first[t - 1, :n, None], between[gap[t, :n]]
            v = (1 - a) * w[:, 0] + a * w[:, 1]
        x = v[:, 1] * phi[t, :n]
        first[t, :n] = x / (v[:, 0] + x)
    share = np.zeros(emit.shape)
    back = ends[tail]
    for t in range(len(emit) - 1, -1, -1):
        n = live[t]
        a, b = first[t, :n], back[:n]
        x = a * b[:, 1]
        share[t, :n] = x / (x + (1 - a) * b[:, 0])
        if t:
            w = between[gap[t, :n]]
            v = w[:, :, 0] * b[:, :1] + w[:, :, 1] * (b[:, 1] * phi[t, :n])[:, None]
            back[:n] = v / v.sum(1, keepdims=True)
    return share


class Tagger:
    """Weights of features, transitions and the document function."""

    def __init__(self, features: dict[str, float], bias: float, transitions, document):
        self.features, self.bias = features, bias
        self.transitions, self.document = np.array(transitions), np.array(document)
        self._forget()

    def _forget(self):
        self.seen, self.emit = Numbering(), np.zeros(1024)

    def emissions(self, text: str) -> np.ndarray:
        """Emission of each word; NaN for background words."""
        parts = text.split()
        known = len(self.seen)
        rows = np.fromiter(map(self.seen.__getitem__, parts), np.int64, len(parts))
        if len(self.seen) > known:
            if len(self.seen) > len(self.emit):
                self.emit = np.concatenate([self.emit, np.zeros(max(len(self.emit), len(self.seen)))])
            get = self.features.get
            for k, word in enumerate(self.seen.take(), known):
                found = [x for f in word_features(word) if (x := get(f)) is not None]
                self.emit[k] = self.bias + sum(found) if found else np.nan
        return self.emit[rows]

    def marginals(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """(numbers of the words with features, their marginals, words) of each text."""
        if len(self.seen) > CACHE:
            self._forget()
        emits = [self.emissions(t) for t in texts]
        at = [np.flatnonzero(~np.isnan(e)) for e in emits]
        out = [(a, np.zeros(0), len(e)) for a, e in zip(at, emits)]
        order = sorted((i for i in range(len(at)) if len(at[i])), key=lambda i: -len(at[i]))
        k = 0
        while k < len(order):
            n = max(1, CELLS // len(at[order[k]]))
            group, k = order[k:k + n], k + n
            emit, size, _ = _by_time([emits[i][at[i]] for i in group])
            gap, _, _ = _by_time([np.diff(at[i], prepend=-1) - 1 for i in group])
            tail = np.array([len(emits[i]) - 1 - at[i][-1] for i in group])
            share = active_marginals(emit, gap, tail, size, self.bias, self.transitions)
            for col, i in enumerate(group):  # already longest first
                out[i] = at[i], share[: size[col], col], len(emits[i])
        return out

    def score(self, share: np.ndarray, words: int) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.document @ document_measures(share, words), -30, 30))))


def spans(text: str, at: np.ndarray, share: np.ndarray) -> list[dict]:
    """Runs of words with a marginal over one half, in characters."""
    toxic = {int(k): float(p) for k, p in zip(at, share) if p > 0.5}
    out = []
    for k, m in enumerate(_WORD.finditer(text) if toxic else ()):
        if k in toxic:
            if out and out[-1]["last"] == k - 1:
                out[-1] |= {"end": m.end(), "last": k, "p": max(out[-1]["p"], toxic[k])}
            else:
                out.append({"start": m.start(), "end": m.end(), "last": k, "p": toxic[k]})
    return [{c: s[c] for c in ("start", "end", "p")} for s in out]


def tied_features(docs: list[set[str]], toxic: np.ndarray) -> set[str]:
    """Features that a lower confidence bound ties to toxic documents."""
    count = {1: Counter(), 0: Counter()}
    for d, y in zip(docs, toxic):
        count[int(y)].update(d)
    n1, n0 = int(toxic.sum()), int((toxic == 0).sum())
    out = set()
    for f, t in count[1].items():
        c = count[0][f]
        odds = np.log((t + 0.5) / (n1 + 1)) - np.log((c + 0.5) / (n0 + 1))
        if t >= 3 and odds - 1.64 * np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)) > MIN_ODDS:
            out.add(f)
    return out


def fit_tagger(texts: list[str], toxic: np.ndarray, share_toxic: float) -> dict:
    """The model, as plain values, from labelled documents."""
    even = np.arange(len(texts)) % 2 == 0
    model = {"features": {}, "bias": 0.0, "transitions": [[0.0, 0.0], [0.0, 0.0]],
             "document": [float(np.log(max(share_toxic, 1e-9) / max(1 - share_toxic, 1e-9))), 0.0, 0.0, 0.0]}
    if len(set(toxic[even])) < 2 or len(set(toxic[~even])) < 2:
        return model
    tokens = [t.split() for t in texts]
    field = np.flatnonzero(even)
    words = Numbering()
    rows = [np.fromiter(map(words.__getitem__, tokens[i]), np.int64, len(tokens[i])) for i in field]
    of_word = [word_features(w) for w in words]
    tied = tied_features([{f for w in set(r.tolist()) for f in of_word[w]} for r in rows], toxic[field])
    toxic_word = np.array([any(f in tied for f in fs) for fs in of_word], bool)
    use = Counter(f for fs in of_word for f in fs if f in tied)
    names = [f for f, _ in use.most_common(MAX_FEATURES)]
    if not names:
        return model
    number = {f: i for i, f in enumerate(names)}
    pair = np.array([(w, number[f]) for w, fs in enumerate(of_word) for f in fs if f in number]).T
    chunks, tags = [], []
    for r, i in zip(rows, field):
        for k in range(0, len(r), CHUNK):
            chunks.append(r[k:k + CHUNK])
            tags.append(toxic_word[chunks[-1]] & bool(toxic[i]))
    seq, size, order = _by_time(chunks)
    tag = np.zeros(seq.shape)
    for col, i in enumerate(order):
        tag[: size[col], col] = tags[i]
    inside = np.arange(len(seq))[:, None] < size
    both = inside[1:]
    seen = np.array([[((1 - tag[:-1]) * (1 - tag[1:]) * both).sum(), ((1 - tag[:-1]) * tag[1:] * both).sum()],
                     [(tag[:-1] * (1 - tag[1:]) * both).sum(), (tag[:-1] * tag[1:] * both).sum()]])
    weight, bias, move = np.zeros(len(names)), -2.0, np.zeros((2, 2))
    moment = [[np.zeros_like(np.asarray(x)) for x in (weight, bias, move)] for _ in range(2)]
    n = inside.sum()
    for step in range(1, STEPS + 1):
        emit = np.bincount(pair[0], weight[pair[1]], len(words)) + bias
        share, counts = forward_backward(np.where(inside, emit[seq], 0.0), size, move, pairs=True)
        slack = (tag - share)[inside]
        by_word = np.bincount(seq[inside], slack, len(words))
        grads = [np.bincount(pair[1], by_word[pair[0]], len(names)) - RIDGE * weight * 10, slack.sum(), seen - counts]
        params = []
        for k, (value, g) in enumerate(zip((weight, bias, move), grads)):  # Adam
            g = g / n
            moment[0][k] = 0.9 * moment[0][k] + 0.1 * g
            moment[1][k] = 0.99 * moment[1][k] + 0.01 * g * g
            scale = np.sqrt(moment[1][k] / (1 - 0.99**step)) + 1e-12
            params.append(value + RATE * moment[0][k] / (1 - 0.9**step) / scale)
        weight, bias, move = params
    model |= {"features": dict(zip(names, weight.tolist())), "bias": float(bias), "transitions": move.tolist()}
    tagger = Tagger(**model)
    rest = np.flatnonzero(~even)
    x = np.array([document_measures(s, n) for _, s, n in tagger.marginals([texts[i] for i in rest])])
    y = toxic[rest].astype(float)
    sample_weight = np.where(y == 1, share_toxic / max(y.mean(), 1e-9), (1 - share_toxic) / max(1 - y.mean(), 1e-9))
    coef = np.array(model["document"])
    for _ in range(50):  # Newton steps, a little ridge
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        h = (x * (sample_weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        coef = coef + np.clip(np.linalg.solve(h, x.T @ (sample_weight * (y - p)) - 0.05 * coef), -2, 2)
    return model | {"document": coef.tolist()}


def learning_rows(id_col: str = "doc_id"):
    """True for ids whose labels may be learned from."""
    return F.expr(f"crc32(coalesce(cast({id_col} AS string), '')) % 4 <> 2")


def learning_sample(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", max_per_class: int = MAX_PER_CLASS) -> tuple[DataFrame, float]:
    """(y, t) of at most ``max_per_class`` documents of each class, one row of
    each id (that of the least hash of its text), and the share of class 1."""
    lab = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y"))
           .where("doc_id IS NOT NULL AND y IN (0, 1)").where(learning_rows("doc_id"))
           .groupBy("doc_id").agg(F.max("y").alias("y")))
    share = lab.agg(F.avg("y")).first()[0] or 0.0
    order = F.xxhash64("doc_id")
    sample = lab.where("y = 1").orderBy(order).limit(max_per_class).union(
        lab.where("y = 0").orderBy(order).limit(max_per_class))
    docs = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    picked = (docs.join(F.broadcast(sample), "doc_id")  # at most 2 * max_per_class rows
              .where(F.char_length("t") <= MAX_CHARS).groupBy("doc_id")
              .agg(F.min_by(F.struct("y", "t"), F.struct(F.xxhash64("t"), "t")).alias("r")).select("r.*"))
    return picked, share


def learn(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_per_class: int = MAX_PER_CLASS) -> dict:
    """The model of a bounded sample of the learning labels."""
    picked, share = learning_sample(documents, labels, id_col, text_col, label_col, max_per_class)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(b.column("t").to_pylist(), b.column("y").to_pylist())]
        model = fit_tagger([t for t, _ in rows], np.array([y for _, y in rows], int), share)
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(model)])], ["model"])

    row = picked.repartition(1).sortWithinPartitions(F.xxhash64("t"), "t", "y").mapInArrow(fit, "model string").first()
    return json.loads(row.model) if row else fit_tagger([], np.zeros(0, int), share)  # no partition ran


def score_documents(documents: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, spans) of every row."""
    sent = documents.sparkSession.sparkContext.broadcast(model)  # at most MAX_FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(**sent.value)
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                texts = [t or "" for t in part.column("t").to_pylist()]
                shares = tagger.marginals(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([tagger.score(s, n) for _, s, n in shares], pa.float64()),
                     pa.array([spans(t, at, s) for t, (at, s, _) in zip(texts, shares)],
                              pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))],
                    ["doc_id", "score", "spans"])

    own = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, score double, spans array<struct<start:int,end:int,p:double>>")
