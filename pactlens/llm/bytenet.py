"""A small convolutional network over bytes, in numpy.

Bytes are embedded and a document is cut into overlapping chunks that cover all of it.  Learned filters slide over each
chunk; their responses are rectified and max-pooled, so a chunk is one vector.  A hidden layer turns that vector into
features, the document takes the mean and the maximum of each feature over its chunks, and a logistic layer makes one
probability of these.
"""

from __future__ import annotations

import numpy as np

CHUNK = 512
OVERLAP = 64
WIDTH = 12
STRIDE = 3
EMBED = 6
FILTERS = 40
HIDDEN = 16
#: Positions convolved at once while scoring, which bounds memory whatever the length of a text.
POSITIONS = 60_000
_PAD = 256


def chunks_of(data: bytes) -> np.ndarray:
    """Overlapping chunks (rows) that cover the whole text; the last is filled up with a padding symbol."""
    raw = np.frombuffer(data, np.uint8)
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(raw) - OVERLAP) // step))
    out = np.full((n, CHUNK), _PAD, np.int16)
    for i in range(n):
        part = raw[i * step : i * step + CHUNK]
        out[i, : len(part)] = part
    return out


_STARTS = np.arange(0, CHUNK - WIDTH + 1, STRIDE)


class ByteNet:
    def __init__(self, seed: int = 0):
        draw = np.random.default_rng(seed)
        self.p = {
            "embed": draw.normal(0, 0.5, (257, EMBED)).astype(np.float32),
            "filters": draw.normal(0, (WIDTH * EMBED) ** -0.5 * 2, (WIDTH * EMBED, FILTERS)).astype(np.float32),
            "offset": np.zeros(FILTERS, np.float32),
            "hidden": draw.normal(0, FILTERS**-0.5 * 1.4, (FILTERS, HIDDEN)).astype(np.float32),
            "hidden_offset": np.zeros(HIDDEN, np.float32),
            "out": draw.normal(0, 0.1, 2 * HIDDEN).astype(np.float32),
            "out_offset": np.zeros(1, np.float32),
        }
        self.p["embed"][_PAD] = 0

    def _responses(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, positions, filters) before rectifying."""
        seen = self.p["embed"][chunks]
        windows = np.lib.stride_tricks.sliding_window_view(seen, WIDTH, axis=1)[:, ::STRIDE]
        flat = windows.transpose(0, 1, 3, 2).reshape(-1, WIDTH * EMBED)
        return (flat @ self.p["filters"]).reshape(len(chunks), len(_STARTS), FILTERS)

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        step = max(1, POSITIONS // len(_STARTS))
        out = [self._responses(chunks[i : i + step]).max(axis=1) for i in range(0, len(chunks), step)]
        return np.maximum(np.concatenate(out) + self.p["offset"], 0)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """One probability for each text.  The chunks of all texts go through in blocks of bounded size."""
        features, owner, waiting = [], [], []

        def flush() -> None:
            if waiting:
                pooled = self.pooled(np.concatenate(waiting))
                features.append(np.maximum(pooled @ self.p["hidden"] + self.p["hidden_offset"], 0))
                waiting.clear()

        total = 0
        for i, data in enumerate(texts):
            step = (CHUNK - OVERLAP) * 256
            for at in range(0, max(1, len(data) - OVERLAP), step):
                part = chunks_of(data[at : at + step + OVERLAP])
                waiting.append(part)
                owner.append(np.full(len(part), i))
                total += len(part)
                if total >= 512:
                    flush()
                    total = 0
        flush()
        if not texts:
            return np.empty(0)
        rows, own = np.concatenate(features), np.concatenate(owner)
        firsts = np.searchsorted(own, np.arange(len(texts)))
        mean = np.add.reduceat(rows, firsts, axis=0) / np.bincount(own, minlength=len(texts))[:, None]
        most = np.maximum.reduceat(rows, firsts, axis=0)
        logit = np.concatenate([mean, most], axis=1) @ self.p["out"] + self.p["out_offset"]
        return 1 / (1 + np.exp(-logit.astype(np.float64)))

    def fit(self, documents: list[np.ndarray], labels: np.ndarray, epochs: int = 6, batch: int = 32, rate: float = 3e-3, seed: int = 0) -> None:
        """Adam on the logistic loss; each document is a matrix of chunks."""
        draw = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        steps, total = 0, epochs * max(1, -(-len(documents) // batch))
        for _ in range(epochs):
            order = draw.permutation(len(documents))
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                grads = self._gradients([documents[i] for i in chosen], labels[chosen])
                steps += 1
                now = rate * (1 - 0.9 * steps / total)
                for k, g in grads.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    self.p[k] -= now * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.99**steps)) + 1e-8)
                self.p["embed"][_PAD] = 0

    def _gradients(self, documents: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        chunks = np.concatenate(documents)
        sizes = np.array([len(d) for d in documents])
        firsts = np.r_[0, np.cumsum(sizes)[:-1]]
        own = np.repeat(np.arange(len(documents)), sizes)
        responses = self._responses(chunks)
        where = responses.argmax(axis=1)
        top = np.take_along_axis(responses, where[:, None, :], axis=1)[:, 0] + p["offset"]
        pooled = np.maximum(top, 0)
        pre = pooled @ p["hidden"] + p["hidden_offset"]
        rows = np.maximum(pre, 0)
        mean = np.add.reduceat(rows, firsts, axis=0) / sizes[:, None]
        most = np.maximum.reduceat(rows, firsts, axis=0)
        joined = np.concatenate([mean, most], axis=1)
        score = 1 / (1 + np.exp(-(joined @ p["out"] + p["out_offset"])))
        d_logit = ((score - labels) / len(labels)).astype(np.float32)
        g = {"out": joined.T @ d_logit, "out_offset": d_logit.sum(keepdims=True)}
        d_joined = d_logit[:, None] * p["out"]
        d_rows = (d_joined[:, :HIDDEN] / sizes[:, None])[own]
        top_rows = (rows == most[own]).astype(np.float32)  # equal chunks share the gradient
        d_rows = d_rows + top_rows * (d_joined[:, HIDDEN:] / np.add.reduceat(top_rows, firsts, axis=0))[own]
        d_pre = d_rows * (pre > 0)
        g["hidden"], g["hidden_offset"] = pooled.T @ d_pre, d_pre.sum(axis=0)
        d_top = (d_pre @ p["hidden"].T) * (top > 0)
        g["offset"] = d_top.sum(axis=0)
        # Only the window that won the pooling has a gradient.
        at = _STARTS[where][:, :, None] + np.arange(WIDTH)
        symbols = np.take_along_axis(chunks[:, None, :], at.reshape(len(chunks), 1, -1), axis=2).reshape(at.shape).astype(np.int64)
        seen = p["embed"][symbols].reshape(len(chunks), FILTERS, WIDTH * EMBED)
        g["filters"] = np.einsum("cfw,cf->wf", seen, d_top)
        d_seen = d_top[:, :, None] * p["filters"].T[None]
        flat, d_flat = symbols.reshape(-1), d_seen.reshape(-1, EMBED)
        sums = [np.bincount(flat, weights=d_flat[:, e], minlength=_PAD + 1) for e in range(EMBED)]
        g["embed"] = np.stack(sums, axis=1).astype(np.float32)
        return g
