"""A convolutional classifier over symbols, trained in numpy.

Every symbol has an embedding; filters of several widths run over it; each filter's
largest response in a sequence is kept; a softmax reads those. As symbols are discrete,
a filter's response is a sum of table entries, one table for each place in the filter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Network:
    embedding: np.ndarray                 # symbols x depth; the last symbol is padding, all zero
    filters: list[np.ndarray]             # for each width: width x depth x count
    bias: list[np.ndarray]
    head: np.ndarray
    shift: np.ndarray

    @classmethod
    def new(cls, symbols: int, classes: int, depth: int, widths: tuple, count: int, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        embedding = draw(symbols + 1, depth, scale=0.5)
        embedding[-1] = 0
        return cls(embedding, [draw(w, depth, count, scale=(1 / (w * depth)) ** 0.5) for w in widths],
                   [np.zeros(count, np.float32) for _ in widths],
                   draw(count * len(widths), classes, scale=0.1), np.zeros(classes, np.float32))

    @property
    def pads(self) -> int:
        """Padding symbols needed after each sequence."""
        return max(len(f) for f in self.filters) - 1

    def tables(self) -> list[list[np.ndarray]]:
        """For each width and place the response of every symbol."""
        return [[np.ascontiguousarray(self.embedding @ f[k]) for k in range(len(f))] for f in self.filters]

    @staticmethod
    def respond(tables: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
        """The responses at every place of a padded stream; the last places see nothing beyond."""
        out = tables[0].take(ids, axis=0)
        for k, table in enumerate(tables[1:], 1):
            out[:-k] += table.take(ids[k:], axis=0)
        return out

    def logits(self, pooled: list[np.ndarray]) -> np.ndarray:
        hidden = np.concatenate([np.maximum(p + b, 0) for p, b in zip(pooled, self.bias)], axis=1)
        return hidden @ self.head + self.shift


def softmax(logits: np.ndarray) -> np.ndarray:
    exp = np.exp(logits - logits.max(axis=1, keepdims=True))
    return exp / exp.sum(axis=1, keepdims=True)


def train(network: Network, sequences: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, epochs: int,
          rate: float = 0.01, batch: int = 32, decay: float = 1e-4, seed: int = 11) -> Network:
    """Fits the network by Adam on weighted cross-entropy; the same data give the same network."""
    rng = np.random.default_rng(seed)
    slots = [network.embedding, *network.filters, *network.bias, network.head, network.shift]
    mean, square = [np.zeros_like(s) for s in slots], [np.zeros_like(s) for s in slots]
    pad = len(network.embedding) - 1
    widths = len(network.filters)
    gap = np.full(network.pads, pad, np.int64)
    step = 0
    steps = max(1, epochs * -(-len(sequences) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(sequences))
        for start in range(0, len(order), batch):
            some = order[start : start + batch]
            parts = [x for k in some for x in (sequences[k] if len(sequences[k]) else np.array([pad]), gap)]
            ids = np.concatenate(parts)
            size = [max(len(sequences[k]), 1) + len(gap) for k in some]
            begin = np.cumsum([0, *size[:-1]])
            tables = network.tables()
            pooled, best = [], []
            for group in tables:
                out = network.respond(group, ids)
                where = np.stack([b + out[b : b + n - len(gap)].argmax(axis=0) for b, n in zip(begin, size)])
                best.append(where)
                pooled.append(np.take_along_axis(out, where, axis=0))
            hidden = np.concatenate([np.maximum(p + b, 0) for p, b in zip(pooled, network.bias)], axis=1)
            chance = softmax(hidden @ network.head + network.shift)
            chance[np.arange(len(some)), labels[some]] -= 1
            g = (chance * (weights[some] / weights[some].sum())[:, None]).astype(np.float32)
            grads = [np.zeros_like(s) for s in slots]
            grads[-1] = g.sum(axis=0)
            grads[-2] = hidden.T @ g
            back = (g @ network.head.T) * (hidden > 0)
            at = 0
            for w, f in enumerate(network.filters):
                count = f.shape[2]
                mine = back[:, at : at + count]
                at += count
                grads[1 + widths + w] = mine.sum(axis=0)
                for k in range(len(f)):
                    seen = ids[np.minimum(best[w] + k, len(ids) - 1)]
                    rows, place = np.unique(seen, return_inverse=True)
                    table = np.zeros((len(rows), count), np.float32)
                    np.add.at(table, (place.reshape(seen.shape), np.arange(count)[None, :]), mine)
                    grads[1 + w][k] = network.embedding[rows].T @ table
                    grads[0][rows] += table @ f[k].T
            grads[0][-1] = 0
            step += 1
            now = rate * (1 - 0.9 * step / steps)
            for slot, grad, m, v in zip(slots, grads, mean, square):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                slot -= now * ((m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + decay * slot)
            network.embedding[-1] = 0
    return network
