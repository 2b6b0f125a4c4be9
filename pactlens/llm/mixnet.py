"""Bit predictors over hashed contexts and their online mixing, in numpy.

A text becomes a stream of bytes: its words, lower-cased, each followed by a space, and a line feed as its end.  A Huffman
code makes a byte a few bits, and every bit is predicted by counts kept under a hash of a context and the bits of the byte so far.  Contexts are the last
2, 3 and 4 bytes and the current word so far; none reaches beyond the start of the text.

The predictions are mixed in the logistic domain.  The place of the bit in its byte's code and the longest context that is
known gate the weights.  Weights and a bias start from trained values in every text and are refined online: after every block of
bytes they take a gradient step on what the block cost.  At the end of each word the chance of its bits is joined with its
chance by count alone, again in adaptive shares.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np

SLOT_BITS = 20
ORDERS = 4
GATES = 3
BLOCK = 1024
#: Bytes whose bits are looked up at once; bounds memory whatever the length of a text.
PIECE_BYTES = 32_768
RATE = 0.0005
_ODD = [np.uint32(x | 1) for x in (0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)]
_BASE = 0xD1342543DE82EF95
_SCALE = 12.0

#: Letters from frequent to rare, as in many languages of Europe; only the order of decisions hangs on it.
_LETTERS = b"etaoinshrdlcumwfgypbvkjxqz"


def code_tree() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A Huffman code of the bytes for rough frequencies, so that a common byte takes few decisions.

    For each byte the number of its bits and where they start in two flat arrays: the inner node each decision is made
    at, and the bit.
    """
    weight = np.full(256, 0.01)
    weight[32] = 18
    for rank, letter in enumerate(_LETTERS):
        weight[letter] = 9 * 0.86**rank
    weight[0x80:0xC0] = 0.05
    weight[0xC3] = 1.5
    for mark, share in zip(b",.\n0123456789", [1.0, 1.0, *[0.2] * 11], strict=True):
        weight[mark] = share
    heap = [(w, i, i) for i, w in enumerate(weight.tolist())]
    heapq.heapify(heap)
    above: dict[int, tuple[int, int]] = {}
    for node in range(256, 511):
        one, two = heapq.heappop(heap), heapq.heappop(heap)
        above[one[2]], above[two[2]] = (node, 0), (node, 1)
        heapq.heappush(heap, (one[0] + two[0], node, node))
    sizes, nodes, bits = [], [], []
    for byte in range(256):
        path, at = [], byte
        while at in above:
            at, bit = above[at]
            path.append((at, bit))
        sizes.append(len(path))
        nodes += [n for n, _ in path[::-1]]
        bits += [x for _, x in path[::-1]]
    first = np.r_[0, np.cumsum(sizes)[:-1]]
    return np.array(sizes), first, np.array(nodes, np.uint32) * np.uint32(0x9E3779B1), np.array(bits, np.uint8)


SIZES, FIRST, NODES, BITS = code_tree()
DEPTHS = 8


def decisions(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For bytes laid end to end: how many decisions each takes, and the depth, node and bit of every decision."""
    sizes = SIZES[raw]
    ends = np.cumsum(sizes)
    depth = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    place = depth + np.repeat(FIRST[raw], sizes)
    return sizes, depth, NODES[place], BITS[place]


def stream(words: list[bytes]) -> bytes:
    return b" ".join([*words, b"\n"])


#: A piece of a stream, and how many bytes at its head are only there as context.
Piece = tuple[bytes, int]


def pieces(text: bytes, most: int = PIECE_BYTES) -> list[Piece]:
    """A stream in parts that end with a word, each with the four bytes before it."""
    out, at = [], 0
    while at < len(text):
        end = len(text) if at + most >= len(text) else text.rfind(b" ", at, at + most) + 1 or text.find(b" ", at + most) + 1 or len(text)
        lead = min(4, at)
        out.append((text[at - lead : end], lead))
        at = end
    return out


def runs(parts: Iterable[tuple[int, Piece]], most: int = PIECE_BYTES) -> Iterator[list[tuple[int, Piece]]]:
    """Numbered pieces, as many at once as come to about ``most`` bytes."""
    run, size = [], 0
    for part in parts:
        run.append(part)
        size += len(part[1][0])
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def contexts(parts: list[Piece]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pieces laid end to end, without their leads: the bytes, the start of each piece, a 32-bit hash for each order and
    byte."""
    raw = np.frombuffer(b"".join([x for x, _ in parts]), np.uint8)
    n = len(raw)
    sizes = np.array([len(x) for x, _ in parts])
    starts = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
    first = np.zeros(n, np.int64)
    first[starts] = starts
    place = np.arange(n) - np.maximum.accumulate(first)
    out = np.zeros((ORDERS, n), np.uint32)
    so_far = np.zeros(n, np.uint32)
    for j in range(1, 5):
        before = np.zeros(n, np.uint32)
        before[j:] = raw[:-j].astype(np.uint32) + 1 if n > j else 0
        before[place < j] = 0
        so_far = (so_far + before) * np.uint32(0x2C1B3C6D)
        so_far ^= so_far >> np.uint32(15)
        if j > 1:
            out[j - 2] = so_far * _ODD[j - 2]
    # The current word: from the byte after the last space, or from the start.
    word = np.zeros(n, np.int64)
    after = np.flatnonzero(raw[:-1] == 32) + 1
    word[after] = after
    word[starts] = starts
    word = np.maximum.accumulate(word)
    steps = np.full(n + 1, _BASE, np.uint64)
    steps[0] = 1
    up = np.cumprod(steps, dtype=np.uint64)
    steps[1:] = pow(_BASE, -1, 1 << 64)
    down = np.cumprod(steps, dtype=np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * down[:-1], out=sums[1:])
    own = (sums[:-1] - sums[word]) * up[word]
    own ^= own >> np.uint64(29)
    out[3] = ((own * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.uint32) + _ODD[3]
    leads = np.array([lead for _, lead in parts])
    if leads.any():
        keep = place >= np.repeat(leads, sizes)
        raw, out, starts = raw[keep], out[:, keep], np.r_[0, np.cumsum(sizes - leads)[:-1]]
    return raw, starts, out


def slots(context: np.ndarray, sizes: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Places in a table, of the context of a byte and the node of each of its decisions."""
    at = np.repeat(context, sizes)
    at ^= nodes
    at *= np.uint32(0x85EBCA6B)
    at ^= at >> np.uint32(13)
    at *= np.uint32(0xC2B2AE35)
    at >>= np.uint32(32 - SLOT_BITS)
    return at


def count_bits(texts: list[bytes], counts: np.ndarray) -> None:
    """Add the bits of some streams to ``counts`` (ORDERS, 2 * slots): zeros and ones side by side.  A byte that comes after
    the same context again takes the same slots, so each is looked up once and added as often as it came."""
    for run in runs(((0, x) for t in texts for x in pieces(t)), 32 * PIECE_BYTES):
        raw, _, hashes = contexts([x for _, x in run])
        for o in range(ORDERS):
            met = hashes[o].astype(np.uint64) << np.uint64(8)
            met |= raw
            met.sort()
            first = np.flatnonzero(np.r_[True, met[1:] != met[:-1]]) if len(met) else np.empty(0, np.intp)
            times = np.diff(first, append=len(met)).astype(counts.dtype)
            met = met[first]
            sizes, _, nodes, bits = decisions(met.astype(np.uint8))
            at = slots((met >> np.uint64(8)).astype(np.uint32), sizes, nodes)
            at <<= np.uint32(1)
            at |= bits
            np.add.at(counts[o], at, np.repeat(times, sizes))


def tables(counts: np.ndarray) -> np.ndarray:
    """Logits of the bits, as small integers; 0 for a slot without counts."""
    zero, one = counts[:, 0::2].astype(np.float32), counts[:, 1::2].astype(np.float32)
    return np.clip(np.round(np.log((one + 0.1) / (zero + 0.1)) * _SCALE), -127, 127).astype(np.int8)


def first_weights() -> np.ndarray:
    weights = np.full((ORDERS + 1, GATES * DEPTHS), 0.35, np.float32)
    weights[ORDERS] = 0
    return weights


class Mixer:
    def __init__(self, table: np.ndarray, weights: np.ndarray, rate: float = RATE):
        self.table, self.weights, self.rate = table, weights, rate

    def inputs(self, parts: list[Piece]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the pieces; where the decisions of each byte begin, and the end; logits of the bits that came
        (ORDERS + 1, decisions); and which weights each decision takes."""
        raw, starts, hashes = contexts(parts)
        sizes, depth, nodes, bits = decisions(raw)
        begins = np.r_[0, np.cumsum(sizes)]
        sign = bits.astype(np.int8) * np.int8(2) - np.int8(1)
        x = np.empty((ORDERS + 1, len(sign)), np.float32)
        known = []
        for o in range(ORDERS):
            found = np.take(self.table[o], slots(hashes[o], sizes, nodes))
            if o >= ORDERS - 2:
                known.append(found[begins[:-1]] != 0)
            found *= sign
            np.multiply(found, np.float32(1 / _SCALE), out=x[o])
        x[ORDERS] = sign
        gate = (np.where(known[1], 2, np.where(known[0], 1, 0)) * DEPTHS).astype(np.int8)
        return starts, begins, x, np.repeat(gate, sizes) + np.minimum(depth, DEPTHS - 1).astype(np.int8)

    def block(self, weights: np.ndarray, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Chances of the bits that came; ``weights`` (ORDERS + 1, GATES * DEPTHS) take their step."""
        own = gate.astype(np.intp)
        z = x[0] * weights[0][own]
        for k in range(1, ORDERS + 1):
            z += x[k] * weights[k][own]
        np.clip(z, -9, 9, out=z)
        np.negative(z, out=z)
        np.exp(z, out=z)
        z += 1
        chance = np.reciprocal(z)
        miss = 1 - chance
        for k in range(ORDERS + 1):
            weights[k] += self.rate * np.bincount(own, weights=miss * x[k], minlength=weights.shape[1]).astype(np.float32)
        return chance

    def _bytes(self, weights: np.ndarray, a: int, b: int, begins: np.ndarray, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Natural logarithms of the chances of bytes a to b, block by block."""
        out = []
        for at in range(a, b, BLOCK):
            stop = min(b, at + BLOCK)
            own = slice(begins[at], begins[stop])
            chance = self.block(weights, x[:, own], gate[own])
            out.append(np.add.reduceat(np.log(chance), begins[at:stop] - begins[at]))
        return np.concatenate(out)

    def scores(self, texts: list[bytes], priors: list[np.ndarray]) -> np.ndarray:
        """Natural logarithm of the chance of each stream; every stream starts from the trained weights.

        ``priors``: for each token the logarithm of its chance by count alone, -inf for a token not known.  Bits and
        counts are joined token by token, in shares that follow what either has foretold so far in the text.
        """
        out = np.zeros(len(texts))
        logs: list[np.ndarray] = []
        weights, last = self.weights.copy(), 0

        def close(i: int) -> None:
            raw = np.frombuffer(texts[i], np.uint8)
            first = np.r_[0, np.flatnonzero(raw[:-1] == 32) + 1]
            out[i] = join_shares(np.add.reduceat(np.concatenate(logs), first), priors[i])
            logs.clear()

        for run in runs((i, x) for i, t in enumerate(texts) for x in pieces(t)):
            starts, begins, x, gate = self.inputs([piece for _, piece in run])
            ends = np.r_[starts[1:], len(begins) - 1]
            for (i, _), a, b in zip(run, starts.tolist(), ends.tolist(), strict=True):
                if i != last:
                    close(last)
                    weights, last = self.weights.copy(), i
                logs.append(self._bytes(weights, a, b, begins, x, gate))
        if texts:
            close(last)
        return out

    def learn(self, texts: list[bytes]) -> None:
        """Let the weights themselves go through the streams."""
        for run in runs((0, x) for t in texts for x in pieces(t)):
            _, begins, x, gate = self.inputs([piece for _, piece in run])
            self._bytes(self.weights, 0, len(begins) - 1, begins, x, gate)


def join_shares(by_bits: np.ndarray, by_counts: np.ndarray, block: int = 64) -> float:
    """Sum of the logarithms of a mixture of two chances, whose shares start even and are refined after every block."""
    bits, counts, total = 8.0, 8.0, 0.0
    for at in range(0, len(by_bits), block):
        share = counts / (bits + counts)
        own = by_counts[at : at + block] + np.log(share)
        both = np.logaddexp(own, by_bits[at : at + block] + np.log1p(-share))
        total += float(both.sum())
        won = float(np.exp(own - both).sum())
        counts, bits = counts + won, bits + len(both) - won
    return total
