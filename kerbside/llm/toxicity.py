"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

A word enters as two parts: the last states of a bidirectional recurrent pass over its characters, so that inflected and
unseen words are read by their stem, and an embedding if it is in the vocabulary. A second bidirectional pass over the
words of a window, attention pooling and a logistic unit give the window's score. A document has the score of its highest
window. Windows cover the whole text and overlap by half, in fitting and in scoring.

Everything is trained here, in numpy on the driver, on a bounded sample of labelled documents: at most ``SAMPLE`` of
each label, each of at most ``SAMPLE_CHARS`` characters. The character part is fitted first, to tell words that are
typical of toxic documents from others. Then the window network and the embeddings are fitted with one window of each
document, the one that scores highest so far. Scoring runs on the executors with the fitted arrays as a broadcast
(below 2 MB: the vocabulary and the layers have fixed sizes).
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Labelled documents with label 0 and with label 1 that the network is fitted on, and their greatest length.
SAMPLE, SAMPLE_CHARS = (3000, 1500), 20_000
#: Words of a window and the step to the next one: any 17 words lie whole in a window.
WINDOW, STEP = 32, 16
#: Vocabulary, documents a vocabulary word needs, longest piece of a word, character classes.
VOCABULARY, LEAST_DOCS, PIECE, CHARS = 8192, 3, 24, 128
#: Sizes: character embedding, character state, word embedding, window state, attention.
EC, HC, EW, HW, HA = 8, 8, 4, 8, 8
#: A word is typical of toxic documents from this z-score and log ratio on.
TYPICAL_Z, TYPICAL_RATIO = 6.0, 1.5
CHAR_STEPS, EPOCHS, BATCH, RATE = 400, 10, 128, 0.01
CLEAN_COST = 3
#: Words whose inputs a worker keeps before it starts anew.
CACHED = 300_000
_WORD = re.compile(rf"[^\W_]{{1,{PIECE}}}")


def words(text: str | None) -> list[str]:
    """Lower-cased words of the whole text; a very long word counts as several pieces."""
    return _WORD.findall((text or "").lower())


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def recur(inputs: np.ndarray, index: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: bool = False):
    """Gated recurrent pass; step t of sequence i reads row ``index[t, i]`` of ``inputs (rows, 3h)``.

    Gives the states of every step, and what the backward pass needs.
    """
    h = len(u)
    state = np.zeros((index.shape[1], h), np.float32)
    states, cache = np.empty((len(index), *state.shape), np.float32), []
    for rows, m, out in zip(index, mask[:, :, None], states, strict=True):
        x, hu = inputs.take(rows, axis=0), state @ u
        gates = sigmoid(x[:, : 2 * h] + hu[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(x[:, 2 * h :] + r * hu[:, 2 * h :])
        if keep:
            cache.append((state, z, r, new, hu[:, 2 * h :], m))
        np.add(state, m * (1 - z) * (new - state), out=out)
        state = out
    return states, cache


def recur_back(d_states: np.ndarray, cache: list, u: np.ndarray):
    """Gradients of the inputs and of ``u`` for gradients of the states of every step."""
    steps, n, h = d_states.shape
    dx, du, carried = np.empty((steps, n, 3 * h), u.dtype), np.zeros_like(u), np.zeros((n, h), u.dtype)
    for t in reversed(range(steps)):
        before, z, r, new, hn, m = cache[t]
        d = carried + d_states[t]
        dm = d * m
        d_new = dm * (1 - z) * (1 - new * new)
        d_z = dm * (before - new) * z * (1 - z)
        d_r = d_new * hn * r * (1 - r)
        dx[t] = np.concatenate([d_z, d_r, d_new], axis=1)
        d_hu = np.concatenate([d_z, d_r, d_new * r], axis=1)
        du += before.T @ d_hu
        carried = d * (1 - m) + dm * z + d_hu @ u.T
    return dx, du


@dataclass
class Network:
    """Layers by name, and the vocabulary. Row 0 of the embeddings is for other words."""

    layers: dict[str, np.ndarray]
    vocabulary: dict[str, int] = field(default_factory=dict)
    #: Score of every text if there was nothing to learn from.
    constant: float | None = None

    @staticmethod
    def fresh(seed: int = 7) -> "Network":
        rng = np.random.default_rng(seed)
        make = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        zeros = lambda *shape: np.zeros(shape, np.float32)
        layers = {"chars": 0.5 * make(CHARS, EC) * np.sqrt(CHARS).astype(np.float32), "cv": make(2 * HC, 1), "cb": zeros(1)}
        for side in "fb":
            layers |= {f"c{side}w": make(EC, 3 * HC), f"c{side}u": make(HC, 3 * HC), f"c{side}b": zeros(3 * HC)}
            layers |= {f"w{side}w": make(2 * HC + EW, 3 * HW), f"w{side}u": make(HW, 3 * HW), f"w{side}b": zeros(3 * HW)}
        layers |= {"words": zeros(VOCABULARY + 1, EW), "aw": make(2 * HW, HA), "ab": zeros(HA), "av": make(HA, 1)}
        return Network(layers | {"ow": make(2 * HW, 1), "ob": zeros(1)})

    # Characters of words

    def _codes(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        longest = max(map(len, found))
        flat = np.frombuffer("".join(w.ljust(longest, "\0") for w in found).encode("utf-32-le"), np.uint32)
        flat = flat.reshape(len(found), longest).T
        return (flat % CHARS).astype(np.int64), (flat > 0).astype(np.float32)

    def _char_states(self, found: list[str], keep: bool = False):
        codes, mask = self._codes(found)
        p = self.layers
        f, cf = recur(p["chars"] @ p["cfw"] + p["cfb"], codes, mask, p["cfu"], keep)
        b, cb = recur(p["chars"] @ p["cbw"] + p["cbb"], codes[::-1], mask[::-1], p["cbu"], keep)
        return np.concatenate([f[-1], b[-1]], axis=1), (codes, cf, cb, f.shape)

    def inputs(self, found: list[str]) -> np.ndarray:
        """Input of each word: character states and embedding."""
        out = np.empty((len(found), 2 * HC + EW), np.float32)
        order = sorted(range(len(found)), key=lambda i: len(found[i]))
        for at in range(0, len(order), 1024):
            some = order[at : at + 1024]
            out[some, : 2 * HC] = self._char_states([found[i] for i in some])[0]
        out[:, 2 * HC :] = self.layers["words"][[self.vocabulary.get(w, 0) for w in found]]
        return out

    def char_step(self, found: list[str], y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the character part for words ``found`` with labels ``y``."""
        p = self.layers
        h, (codes, cf, cb, shape) = self._char_states(found, True)
        d = ((sigmoid(h @ p["cv"] + p["cb"])[:, 0] - y) * weight / len(y)).astype(np.float32)[:, None]
        dh, g = d @ p["cv"].T, {"cv": h.T @ d, "cb": d.sum(0), "chars": np.zeros_like(p["chars"])}
        for side, cache, seen, part in (("f", cf, codes, dh[:, :HC]), ("b", cb, codes[::-1], dh[:, HC:])):
            last = np.zeros(shape, np.float32)
            last[-1] = part
            dx, g[f"c{side}u"] = recur_back(last, cache, p[f"c{side}u"])
            flat = dx.reshape(-1, 3 * HC)
            g[f"c{side}w"] = p["chars"][seen.ravel()].T @ flat
            g[f"c{side}b"] = flat.sum(0)
            np.add.at(g["chars"], seen.ravel(), flat @ p[f"c{side}w"].T)
        return g

    # Windows of words

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.layers
        return x @ p["wfw"] + p["wfb"], x @ p["wbw"] + p["wbb"]

    def windows(self, xf: np.ndarray, xb: np.ndarray, index: np.ndarray, keep: bool = False):
        """Logits of windows whose words are rows ``index (time, batch)`` of the projected inputs; -1 is no word."""
        p, mask = self.layers, (index >= 0).astype(np.float32)
        f, cf = recur(xf, index, mask, p["wfu"], keep)
        b, cb = recur(xb, index[::-1], mask[::-1], p["wbu"], keep)
        h = np.concatenate([f, b[::-1]], axis=2)
        a = np.tanh(h @ p["aw"] + p["ab"])
        e = np.where(mask > 0, (a @ p["av"])[:, :, 0], -1e9)
        e = np.exp(e - e.max(0)) * (mask > 0)
        share = e / np.maximum(e.sum(0), 1e-9)
        pooled = (h * share[:, :, None]).sum(0)
        logit = (pooled @ p["ow"] + p["ob"])[:, 0]
        return logit, (cf, cb, h, a, share, pooled)

    def window_step(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """Gradients of the window part, and of the word inputs ``x (time, batch, size)``."""
        p = self.layers
        xf, xb = self.project(x.reshape(-1, x.shape[2]))
        index = np.where(mask > 0, np.arange(mask.size).reshape(mask.shape), -1)
        logit, (cf, cb, h, a, share, pooled) = self.windows(xf, xb, index, True)
        d = ((sigmoid(logit) - y) * weight / len(y)).astype(np.float32)[:, None]
        g = {"ow": pooled.T @ d, "ob": d.sum(0)}
        d_pool = d @ p["ow"].T
        dh = share[:, :, None] * d_pool
        d_share = (h * d_pool).sum(2)
        d_e = share * (d_share - (share * d_share).sum(0))
        da = d_e[:, :, None] * p["av"][:, 0] * (1 - a * a)
        g |= {"av": np.einsum("tbk,tb->k", a, d_e)[:, None], "aw": np.einsum("tbi,tbk->ik", h, da), "ab": da.sum((0, 1))}
        dh = dh + da @ p["aw"].T
        dxf, g["wfu"] = recur_back(dh[:, :, :HW], cf, p["wfu"])
        dxb, g["wbu"] = recur_back(dh[::-1, :, HW:], cb, p["wbu"])
        dx = 0
        for side, part in (("f", dxf), ("b", dxb[::-1])):
            g[f"w{side}w"], g[f"w{side}b"] = np.einsum("tbi,tbk->ik", x, part), part.sum((0, 1))
            dx = dx + part @ p[f"w{side}w"].T
        return g, dx


class Adam:
    def __init__(self, layers: dict[str, np.ndarray], rate: float):
        self.layers, self.rate, self.t = layers, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in layers.items()}
        self.v = {k: np.zeros_like(v) for k, v in layers.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.t += 1
        size = np.sqrt(sum(float((g * g).sum()) for g in gradients.values()))
        for k, g in gradients.items():
            g = g * min(1.0, 1.0 / max(size, 1e-9))
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            scale = np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8
            self.layers[k] -= self.rate * self.m[k] / (1 - 0.9**self.t) / scale


def starts(n: int) -> list[int]:
    """First words of the windows that cover ``n`` words."""
    return list(range(0, max(n - WINDOW + STEP, 1), STEP))


def fit(texts: list[str | None], labels: list[int], seed: int = 7) -> Network:
    """A network fitted to whole texts and their labels 0 or 1. With one label only, its score is constant."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        net.constant = float(y.mean()) if len(y) else 0.0
        return net
    docs = [words(t) for t in texts]
    _fit_words(net, docs, y, rng)

    unique = sorted({w for d in docs for w in d})
    number = {w: i for i, w in enumerate(unique)}
    x = net.inputs(unique) if unique else np.zeros((1, 2 * HC + EW), np.float32)
    row = np.array([net.vocabulary.get(w, 0) for w in unique] or [0])
    owner, index = [], []
    for i, d in enumerate(docs):
        ids = np.array([number[w] for w in d], np.int64)
        for s in starts(len(d)):
            part = ids[s : s + WINDOW]
            index.append(np.pad(part, (0, WINDOW - len(part)), constant_values=-1))
            owner.append(i)
    index, owner = np.array(index), np.array(owner)
    first = np.searchsorted(owner, np.arange(len(docs)))
    # So far, a window is as toxic as its most typical word.
    typical = (x[:, : 2 * HC] @ net.layers["cv"] + net.layers["cb"])[:, 0] + x[:, 2 * HC]
    score = np.where(index >= 0, typical[index], -1e9).max(1)
    trained = {k: v for k, v in net.layers.items() if k[0] in "wao"}
    adam = Adam(trained, RATE)
    batch = min(max(len(docs) // 30, 16), BATCH)  # enough steps for a small sample, too
    for epoch in range(EPOCHS):
        if epoch:
            score = _logits(net, index, *net.project(x))
        best = first + np.array([s.argmax() for s in np.split(score, first[1:])])
        order = rng.permutation(len(docs))
        adam.rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            ids = index[best[some]].T
            mask = (ids >= 0).astype(np.float32)
            given = x[ids].copy()
            drop = rng.random(ids.shape) < 0.3  # so that the characters alone suffice
            given[drop, 2 * HC :] = 0
            g, dx = net.window_step(given, mask, y[some], np.ones(len(some)))
            rows, dw = row[ids], dx[:, :, 2 * HC :] * (mask * ~drop)[:, :, None]
            g["words"] = np.zeros_like(net.layers["words"])
            np.add.at(g["words"], rows.ravel(), dw.reshape(-1, EW))
            g["words"][0] = 0
            adam.step(g)
        x[:, 2 * HC :] = net.layers["words"][row]
    highest = np.maximum.reduceat(_logits(net, index, *net.project(x)), first)
    net.layers["ob"] = net.layers["ob"] - np.float32(cut(highest, y))
    return net


def cut(logits: np.ndarray, y: np.ndarray) -> float:
    """The logit that separates the fitted documents best, midway to the next ones. A clean document above it costs
    ``CLEAN_COST`` times as much as a toxic one below it."""
    order = np.argsort(logits, kind="stable")
    logits, y = logits[order].astype(float), y[order]
    # costs[i]: the i lowest documents are below the cut
    missed, clean = np.concatenate([[0], np.cumsum(y)]), np.concatenate([[0], np.cumsum(1 - y)])
    costs = missed + CLEAN_COST * (clean[-1] - clean)
    ends = np.concatenate([[logits[0] - 1], logits, [logits[-1] + 1]])
    middle, gap = (ends[1:] + ends[:-1]) / 2, ends[1:] - ends[:-1]
    best = np.flatnonzero(costs == costs.min())
    return float(middle[best[gap[best].argmax()]])


def _fit_words(net: Network, docs: list[list[str]], y: np.ndarray, rng: np.random.Generator) -> None:
    """Chooses the vocabulary, starts its embeddings with the log ratio of toxic to other documents, fits the characters."""
    counts = Counter(), Counter()
    for d, label in zip(docs, y, strict=True):
        counts[int(label)].update(set(d))
    total, toxic = len(y), float(y.sum())
    seen = counts[0] + counts[1]
    known = sorted(w for w, n in seen.items() if n >= LEAST_DOCS)
    if not known:
        return
    n = np.array([seen[w] for w in known], float)
    k = np.array([counts[1][w] for w in known], float)
    ratio = np.log((k + 0.5) / (toxic + 1)) - np.log((n - k + 0.5) / (total - toxic + 1))
    expected = n * toxic / total
    z = (k - expected) / np.sqrt(expected * (1 - toxic / total) + 0.5)
    most = sorted(np.argsort(-n, kind="stable")[:VOCABULARY])
    net.vocabulary = {known[i]: j + 1 for j, i in enumerate(most)}
    evidence = np.clip(z / 4, -1, 1) * np.clip(ratio, -3, 3)
    net.layers["words"][1 : len(most) + 1, 0] = evidence[most]
    typical = (z >= TYPICAL_Z) & (ratio >= TYPICAL_RATIO)
    if not typical.any():
        typical = z >= z.max()
    yes, no = np.flatnonzero(typical), np.flatnonzero(~typical & (z < TYPICAL_Z / 2))
    if not len(no):
        return
    adam = Adam({k: v for k, v in net.layers.items() if k[0] == "c"}, RATE)
    for step in range(CHAR_STEPS):
        adam.rate = RATE * (1 - 0.9 * step / CHAR_STEPS)
        some = np.concatenate([rng.choice(yes, 64), rng.choice(no, 192)])
        label = np.repeat([1.0, 0.0], [64, 192])
        adam.step(net.char_step([known[i] for i in some], label, np.where(label > 0, 1.0, 2.0)))


def _logits(net: Network, index: np.ndarray, xf: np.ndarray, xb: np.ndarray) -> np.ndarray:
    """Logits of the windows whose words are rows of the projected inputs; -1 stands for no word."""
    out = np.empty(len(index), np.float32)
    for at in range(0, len(index), 1024):
        ids = np.ascontiguousarray(index[at : at + 1024].T)
        out[at : at + 1024] = net.windows(xf, xb, ids[: max(int((ids >= 0).any(1).sum()), 1)])[0]
    return out


class Numbers(dict):
    """Numbers words in the order in which they are first met."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Scorer:
    """Scores texts and keeps the inputs of the words it has met, up to a bound."""

    def __init__(self, net: Network):
        self.net = net
        self._forget()

    def _forget(self) -> None:
        self.number, self.known = Numbers(), 0
        self.xf = self.xb = np.zeros((1024, 3 * HW), np.float32)

    def _learn(self) -> None:
        """Makes the inputs of the words that were numbered since the last call."""
        new = list(self.number)[self.known :]
        if not new:
            return
        if len(self.number) > len(self.xf):
            room = ((0, 2 * len(self.number) - len(self.xf)), (0, 0))
            self.xf, self.xb = np.pad(self.xf, room), np.pad(self.xb, room)
        to = slice(self.known, len(self.number))
        self.xf[to], self.xb[to] = self.net.project(self.net.inputs(new))
        self.known = len(self.number)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.net.constant is not None:
            return np.full(len(texts), self.net.constant)
        if self.known > CACHED:
            self._forget()
        index, owner = [], []
        for i, text in enumerate(texts):
            ids = np.array(list(map(self.number.__getitem__, words(text))), np.int64)
            first = np.array(starts(len(ids)))
            padded = np.full(first[-1] + WINDOW, -1, np.int64)
            padded[: len(ids)] = ids
            index.append(padded[first[:, None] + np.arange(WINDOW)])
            owner.append(np.full(len(first), i))
        self._learn()
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, np.concatenate(owner), _logits(self.net, np.concatenate(index), self.xf, self.xb))
        # Batches differ in the last bits of their sums; equal texts shall have equal scores.
        return sigmoid(out.astype(float)).round(5)


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """Fits to a bounded sample: the first labelled ids of either label by hash, held-out ones excluded."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(~held_out() & F.col("toxic").isin(0, 1)).filter("doc_id is not null").distinct()
    order = F.xxhash64("doc_id", "toxic")
    some = [known.filter(F.col("toxic") == t).orderBy(order, "doc_id").limit(SAMPLE[t]) for t in (0, 1)]
    chosen = some[0].unionByName(some[1])
    short = docs.select("doc_id", "text").filter((F.length("text") <= SAMPLE_CHARS) | F.col("text").isNull())
    rows = short.join(F.broadcast(chosen), "doc_id").orderBy("doc_id", "toxic", F.xxhash64("text")).limit(sum(SAMPLE))
    sample = rows.select("text", "toxic").collect()
    return fit([r["text"] for r in sample], [r["toxic"] for r in sample])


def score(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1, in place of any that it had. Null and empty texts are scored, too."""
    docs = docs.drop("score")
    model = docs.sparkSession.sparkContext.broadcast(net)
    at, names = docs.columns.index(text), [*docs.columns, "score"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = np.concatenate([scorer.scores(texts[i : i + 64]) for i in range(0, len(texts), 64)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names)

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted``.

    Repeated rows get equal scores. Without labels, or with one label only, every score is the share of label 1.
    """
    net = train(docs, labels)
    out = score(docs.select("doc_id", "text"), net)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents scored below 0.5, in the columns they came in."""
    return score(docs, train(docs, labels)).filter("score < 0.5").drop("score")
