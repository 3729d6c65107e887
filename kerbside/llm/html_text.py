"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

Each block has features of its ancestors (tags, words in class, id and role) and of its text (length, links, marks). The
field has one weight for each feature and label, and one for each pair of neighbouring labels; it is trained on labelled
pages by maximum likelihood with the forward-backward recursion, in numpy on the driver, and decoded by Viterbi on the
executors. The training pages are layouts of ``html_pages``: a fixed number, whatever the table holds.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .html_blocks import Block, blocks
from .html_pages import labelled

#: Labelled pages, rounds over them and the weight of the quadratic penalty.
PAGES, ROUNDS, PENALTY = 1200, 12, 1e-4


def features(found: list[Block]) -> list[list[str]]:
    """Names of the features of every block of a page."""
    out = []
    longest = max((len(b.text) for b in found), default=0)
    for i, b in enumerate(found):
        n = len(b.text)
        tags = [tag for tag, _ in b.path]
        names = {f"in {tag}" for tag in tags} | {f"named {w}" for _, ws in b.path for w in ws}
        names |= {f"tag {tags[-1] if tags else ''}", f"length {min(int(math.log2(n + 1)), 9)}"}
        names |= {f"links {min(4 * b.linked // n, 4)}", f"depth {min(len(tags), 6)}"}
        names |= {f"{tags[-1]} named {w}" for w in b.path[-1][1]} if tags else set()
        if n * 4 >= longest:
            names.add("long for the page")
        if b.text[-1] in ".!?":
            names.add("ends a sentence")
        if b.text[0] == "©":
            names.add("copyright")
        if i == 0:
            names.add("first")
        if i == len(found) - 1:
            names.add("last")
        if i and found[i - 1].path == b.path:
            names.add("as before")
        out.append(sorted(names))
    return out


@dataclass
class Field:
    """Weights of features for label 1 against 0, by name, and of pairs of labels."""

    weights: dict[str, float]
    bias: float
    pairs: list[list[float]]

    def scores(self, names: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [self.bias + sum(get(n, 0.0) for n in some) for some in names]

    def decode(self, names: list[list[str]]) -> list[int]:
        """Labels of the best path."""
        scores = self.scores(names)
        if not scores:
            return []
        (a, b), (c, d) = self.pairs
        no, yes, back = 0.0, scores[0], []
        for s in scores[1:]:
            back.append((no + a < yes + c, no + b < yes + d))
            no, yes = max(no + a, yes + c), max(no + b, yes + d) + s
        label = int(yes > no)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


def _expected(scores: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of label 1 for each block, and expected numbers of neighbouring label pairs."""
    n = len(scores)
    unary = np.stack([np.zeros(n), scores], axis=1)
    forward, backward = np.empty((n, 2)), np.zeros((n, 2))
    forward[0] = unary[0]
    for t in range(1, n):
        forward[t] = unary[t] + np.logaddexp(forward[t - 1, 0] + pairs[0], forward[t - 1, 1] + pairs[1])
    for t in range(n - 2, -1, -1):
        x = unary[t + 1] + backward[t + 1]
        backward[t] = np.logaddexp(pairs[:, 0] + x[0], pairs[:, 1] + x[1])
    total = np.logaddexp(*forward[-1])
    both = np.zeros((2, 2))
    for t in range(1, n):
        both += np.exp(forward[t - 1][:, None] + pairs + (unary[t] + backward[t])[None, :] - total)
    return np.exp(forward[:, 1] + backward[:, 1] - total), both


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = ROUNDS, seed: int = 5) -> Field:
    """Maximum likelihood by adaptive gradient steps, a page at a time."""
    number: dict[str, int] = {}
    data = []
    for found, labels in pages:
        if found:
            ids = [np.array([number.setdefault(n, len(number)) for n in names]) for names in features(found)]
            data.append((np.concatenate(ids), np.repeat(np.arange(len(ids)), [len(i) for i in ids]), np.array(labels)))
    w, seen = np.zeros(len(number) + 1), np.full(len(number) + 1, 1e-6)
    pairs, pairs_seen = np.zeros((2, 2)), np.full((2, 2), 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for page in rng.permutation(len(data)):
            ids, row, y = data[page]
            p, both = _expected(np.bincount(row, w[ids], len(y)) + w[-1], pairs)
            observed = np.zeros((2, 2))
            np.add.at(observed, (y[:-1], y[1:]), 1)
            g = np.zeros_like(w)
            np.add.at(g, ids, (y - p)[row])
            g[-1] = (y - p).sum()
            g -= PENALTY * w
            seen += g * g
            w += 0.3 * g / np.sqrt(seen)
            pairs_seen += (observed - both) ** 2
            pairs += 0.3 * (observed - both) / np.sqrt(pairs_seen)
    return Field({n: float(w[i]) for n, i in number.items()}, float(w[-1]), pairs.tolist())


@lru_cache(1)
def default_field() -> Field:
    return train(labelled(PAGES))


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page or "")
    labels = field.decode(features(found))
    return "\n".join(b.text for b, label in zip(found, labels, strict=True) if label)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page; null and empty pages have the empty text.

    Only these columns are read. Repeated rows stay repeated, with equal texts.
    """
    model = pages.sparkSession.sparkContext.broadcast(field or default_field())
    kinds = [f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), model.value) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    small_batches(pages.sparkSession)
    out = pages.select("page_id", "url", "html").mapInArrow(run, ", ".join([*kinds, "text string"]))
    return out.select("*", F.length("text").cast("long").alias("n_chars"))
