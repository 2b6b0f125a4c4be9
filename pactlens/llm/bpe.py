"""BPE encoding and decoding with reuse of content-defined chunks.

A text is cut where a rolling hash of the last bytes says so; equal passages are therefore cut alike wherever they stand,
and a chunk that several documents share is encoded once in a worker.  A cut may fall inside a word, so the edges of a chunk are
not final: at each join the edges of both neighbours are put together and encoded anew, over as many chunks as it takes to
reach white space on both sides.  From there on the chunks' own ids agree exactly with the whole text's, since this
tokenizer never looks across white space: normalisation maps each side by itself, no pattern of the pre-tokenizer holds
white space, and no special token does.

Inside a new chunk, words go through a memo of words, and new words to the tokenizer in batches.  Both memos are bounded;
what they forget costs time only.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.llm.text import read_table, whole_text

VOCABULARY = "word_bpe_49k.json"
CHUNK_BITS = 9
WINDOW = 8
LONGEST_CHUNK = 16_384
#: Entries of the young half of each memo.
MOST_WORDS = 300_000
MOST_CHUNKS = 30_000
_GEAR = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64)
#: What stands before the first white space of a chunk, the whole words between, and what stands after the last.
_EDGES = re.compile(rb"([^ \t-\r]*)[ \t-\r](?:(.*)[ \t-\r])?([^ \t-\r]*)\Z", re.DOTALL)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks: where the hash of the last ``WINDOW`` bytes is zero in its top bits, never inside a character."""
    if not data:
        return []
    raw = np.frombuffer(data, np.uint8)
    gear = _GEAR[raw]
    rolled = gear.copy()
    for j in range(1, min(WINDOW, len(raw))):
        rolled[j:] += gear[: len(raw) - j] << np.uint64(j)
    starts = np.r_[(raw[1:] & 0xC0) != 0x80, True]
    ends = np.flatnonzero((rolled >> np.uint64(64 - CHUNK_BITS) == 0) & starts) + 1
    out, last = [], 0
    for end in [*ends.tolist(), len(data)]:
        while end - last > LONGEST_CHUNK:  # a long stretch without a cut
            last += LONGEST_CHUNK
            while data[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        if end > last:
            out.append(end)
            last = end
    return out


class Memo:
    """A dictionary of bounded size: when the young half is full it becomes the old one, and what is used again moves back."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get(self, key: bytes):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: bytes, value) -> None:
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value


class ChunkEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, and to what these decode to."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.names = [(self.tokenizer.id_to_token(i) or "").encode() for i in range(size)]
        self.words = Memo(MOST_WORDS)
        self.chunks = Memo(MOST_CHUNKS)

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in pieces], add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _words(self, wanted: set[bytes]) -> dict[bytes, bytes]:
        """Ids of each word; those the memo does not have go to the tokenizer together."""
        have = {w: self.words.get(w) for w in wanted}
        new = [w for w, ids in have.items() if ids is None]
        for word, ids in zip(new, self._encode(new), strict=True):
            have[word] = ids
            self.words.put(word, ids)
        return have

    def decode(self, ids: bytes) -> bytes:
        return b" ".join([self.names[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of each text, and what they decode to."""
        out = []
        for at in range(0, len(texts), 100):
            out += self._encode_some([t.encode("utf-8", "replace") for t in texts[at : at + 100]])
        return out

    def _encode_some(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        plans = []  # for each text its chunks: left edge, key of the whole words between, right edge, white space or not
        inner: dict[bytes, bytes | None] = {}
        new: dict[bytes, bytes] = {}
        for data in texts:
            plan, last = [], 0
            for end in cuts(data):
                chunk, last = data[last:end], end
                edges = _EDGES.match(chunk)
                left, body, right = edges.groups(b"") if edges else (chunk, b"", b"")
                key = xxhash.xxh3_128_digest(body) if body else b""
                if body and key not in inner:
                    inner[key] = self.chunks.get(key)
                    if inner[key] is None:
                        new[key] = body
                plan.append((left, key, right, edges is not None))
            plans.append(plan)
        # What is not inside a chunk: the words at the joins, put together from the edges on both sides.
        joined = []
        for plan in plans:
            parts, edge = [], b""  # (word at a join, key of the chunk's body that follows)
            for left, key, right, blank in plan:
                edge += left
                if blank:  # the join ends at white space
                    parts.append((edge, key))
                    edge = right
            parts.append((edge, b""))
            joined.append(parts)
        bodies = {key: body.split() for key, body in new.items()}
        have = self._words(set().union(*bodies.values(), [w for parts in joined for w, _ in parts if w]))
        have[b""] = b""
        for key, own in bodies.items():
            inner[key] = b"".join([have[w] for w in own])
            self.chunks.put(key, inner[key])
        inner[b""] = b""
        out = []
        for parts in joined:
            whole = b"".join([x for word, key in parts for x in (have[word], inner[key])])
            out.append((whole, self.decode(whole)))
        return out


_KEPT: dict[str, ChunkEncoder] = {}


def kept_encoder(path: str | None) -> ChunkEncoder:
    """The encoder of this worker process, which serves all its tasks."""
    path = path or vocabulary_path()
    if path not in _KEPT:
        _KEPT[path] = ChunkEncoder(path)
    return _KEPT[path]


def _encode_rows(path: str | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = kept_encoder(path)
        for batch in batches:
            out = encoder.encode_all(batch["text"].tolist())
            yield pd.DataFrame({
                "id": batch["id"],
                "n_tokens": [len(ids) // 4 for ids, _ in out],
                "ids_sha256": [hashlib.sha256(ids).hexdigest() for ids, _ in out],
                "decoded_sha256": [hashlib.sha256(text).hexdigest() for _, text in out],
            })

    return run


def encode_table(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids, decoded) of every row: the ids of the whole text, and the text they decode to.

    Null text is empty and has no ids.  Repeated rows each give a row; an empty table gives none.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = kept_encoder(path)
        for batch in batches:
            out = encoder.encode_all(batch["text"].tolist())
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x, _ in out]
            yield pd.DataFrame({"id": batch["id"], "n_tokens": [len(x) for x in ids], "ids": ids, "decoded": [x.decode() for _, x in out]})

    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    return rows.mapInPandas(run, "id long, n_tokens long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, without moving ids or texts out of the task."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), whole_text(text_column).alias("text"))
    return rows.mapInPandas(_encode_rows(path), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
