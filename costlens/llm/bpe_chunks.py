"""BPE encoding and decoding that reuses content-defined chunks.

A rolling hash over the last bytes cuts every text into chunks; the same
passage is cut the same way wherever it stands, so documents that share text
share chunks. Documents are dealt to tasks by the smallest hash among their
cuts, which brings copies and near copies together, and a task encodes each
different chunk once. A group of documents with one smallest hash that holds
too much text for one task is split; the list of such groups is bounded by the
number of partitions.

A cut may fall inside a word. The words inside a chunk keep the ids they were
encoded to with the chunk; the word across a join is encoded again together
with a word at either side, and with more of them until the new ids begin and
end with the ids of those words, so that old and new encodings agree exactly. A
text in which a join finds no agreement is encoded as a whole.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import release, shared_copy

#: Bytes of the rolling hash; one in ``CHUNK`` positions is a cut on average.
HASH_BYTES = 16
CHUNK = 1024
#: Bytes of Spark's batches for Python workers; bounds memory only, not what is computed.
BATCH_BYTES = 4 << 20

_MIX = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9)


def rolling_hash(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``HASH_BYTES`` bytes from each position on."""
    if len(raw) < HASH_BYTES:
        return np.empty(0, np.uint64)
    h, step = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(_MIX[0]), 1
    factor = _MIX[1]
    while step < HASH_BYTES:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor = factor * factor % 2**64
        step *= 2
    h = (h ^ (h >> np.uint64(29))) * np.uint64(_MIX[2])
    return h ^ (h >> np.uint64(32))


def cuts_of(raw: bytes) -> tuple[list[int], np.ndarray]:
    """Byte positions of the cuts (character starts inside the text), and the hashes there."""
    b = np.frombuffer(raw, np.uint8)
    h = rolling_hash(b)
    at = np.flatnonzero(h % np.uint64(CHUNK) == 0)
    end = at + HASH_BYTES
    inside = end < len(b)
    inside[inside] = (b[end[inside]] & 0xC0) != 0x80
    return end[inside].tolist(), h[at[inside]]


def chunk_text(text: str) -> list[str]:
    raw = text.encode("utf-8")
    cuts, _ = cuts_of(raw)
    return [raw[s:e].decode("utf-8") for s, e in zip([0, *cuts], [*cuts, len(raw)])]


def sharing_key(text: str) -> int:
    """The smallest hash among the text's cuts; of a text without cuts, a hash of the whole."""
    raw = text.encode("utf-8")
    _, hashes = cuts_of(raw)
    low = int(hashes.min()) if len(hashes) else int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    return low - (1 << 63)


@lru_cache(maxsize=1)
def _loaded(path: str) -> tuple:
    """The tokenizer at ``path`` and its tokens: one for all tasks of a process, whose memory grows with each that is loaded."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    size = max(tokenizer.get_vocab().values()) + 1
    return tokenizer, [(tokenizer.id_to_token(i) or "").encode("utf-8") for i in range(size)]


class ChunkEncoder:
    """Encodes texts with the tokenizer file at ``path``; each different chunk is encoded once.

    The memos are bounded (``most_words`` words, about ``most_bytes`` of
    chunks) and start anew when full.
    """

    #: Words kept of a chunk at either side, for the repair of its joins.
    EDGE = 8

    def __init__(self, path: str, most_words: int = 400_000, most_bytes: int = 8 << 20):
        self.tokenizer, self.tokens = _loaded(path)
        self.most_words, self.most_bytes = most_words, most_bytes
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, tuple[str, str | None, list[str], list[str], bytes]] = {}
        self.held = self.encoded = self.met = 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str], at_once: int = 10_000) -> None:
        """Encode many words as one text; a token belongs to the word it starts in."""
        for k in range(0, len(words), at_once):
            part = words[k : k + at_once]
            got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            starts = np.fromiter((s for s, _ in got.offsets), np.int64, len(got.offsets))
            ends = np.cumsum([len(w) + 1 for w in part])
            cut = [0, *(4 * np.searchsorted(starts, ends)).tolist()]
            raw = np.array(got.ids, "<u4").tobytes()
            self.words.update(zip(part, map(raw.__getitem__, map(slice, cut, cut[1:]))))

    def _learn(self, chunks: list[str]) -> None:
        """Encode the inner words of chunks that are new: words with a space at either side within the chunk."""
        split = {c: c.split(" ") for c in chunks if c not in self.chunks}
        inner = {w for words in split.values() for w in words[1:-1]}
        new = [w for w in inner if w not in self.words]
        if len(self.words) + len(new) > self.most_words:
            # Chunks need the words at their edges: they go with the words, those met here are learnt anew.
            self.words, self.chunks, self.held = {}, {}, 0
            split = {c: c.split(" ") for c in chunks}
            new = list({w for words in split.values() for w in words[1:-1]})
        self._encode_words(new)
        for chunk, words in split.items():
            inside = words[1:-1]
            ids = b"".join(map(self.words.__getitem__, inside))
            self.chunks[chunk] = (words[0], words[-1] if len(words) > 1 else None, inside[: self.EDGE], inside[-self.EDGE :], ids)
            self.held += 4 * len(chunk) + 1000
        self.encoded += len(split)

    def _repair(self, joins: list[tuple[list[str], str, list[str]]]) -> list[bytes | None]:
        """The ids of each join's word between the words before and after it; None without agreement."""
        out: list[bytes | None] = [None] * len(joins)
        todo, width = list(range(len(joins))), 1
        while todo:
            sides = [(joins[k][0][-width:], joins[k][2][:width]) for k in todo]
            ids = self._encode([" ".join([*left, joins[k][1], *right]) for k, (left, right) in zip(todo, sides)])
            again = []
            for k, (left, right), got in zip(todo, sides, ids):
                before = b"".join([self.words[w] for w in left])
                after = b"".join([self.words[w] for w in right])
                if len(before) + len(after) <= len(got) and got.startswith(before) and got.endswith(after):
                    out[k] = got[len(before) : len(got) - len(after)]
                elif width < max(len(joins[k][0]), len(joins[k][2])):
                    again.append(k)
            todo, width = again, 2 * width
        return out

    def encode_many(self, texts: list[str]) -> Iterator[bytes]:
        """The packed little-endian ids of each text."""
        if self.held > self.most_bytes:
            self.chunks, self.held = {}, 0
        cut = [chunk_text(t) for t in texts]
        self.met += sum(map(len, cut))
        self._learn(list({c for chunks in cut for c in chunks}))
        # A join's word starts after the last space of one chunk, runs through
        # chunks without spaces, and ends at the first space of another.
        joins, plan = [], []
        for chunks in cut:
            parts: list[tuple[int, bytes]] = []
            before: list[str] = []
            word = ""
            for c in chunks:
                first, last, head, tail, ids = self.chunks[c]
                word += first
                if last is not None:
                    parts.append((len(joins), ids))
                    joins.append((before, word, head))
                    before, word = tail, last
            parts.append((len(joins), b""))
            joins.append((before, word, []))
            plan.append(parts)
        mended = self._repair(joins)
        for text, parts in zip(texts, plan):
            if any(mended[j] is None for j, _ in parts):
                yield self._encode([text])[0]
            else:
                yield b"".join([x for j, ids in parts for x in (mended[j], ids)])

    def decode(self, ids: bytes) -> str:
        """The text of packed ids: the tokens with a space between, as the tokenizer decodes without a decoder."""
        return b" ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8")


def deal_by_key(docs: DataFrame, split_factor: int = 4) -> DataFrame:
    """``docs`` (with text) repartitioned by sharing key, large groups split.

    A group is split if its bytes exceed the mean partition's over
    ``split_factor``: there are at most partitions times ``split_factor`` such
    groups, and only they are broadcast.
    """

    def add_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [sharing_key(t or "") for t in batch.column(batch.schema.names.index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, "key"])

    keyed = docs.mapInArrow(add_key, docs.withColumn("key", F.lit(0).cast("long")).schema)
    sizes = keyed.groupBy("key").agg(F.sum(F.octet_length("text") + 64).alias("size"))
    sizes = shared_copy(sizes, "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 1
    most = total / (split_factor * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = sizes.where(F.col("size") > most).select("key", F.ceil(F.col("size") / most).alias("ways"))
    dealt = keyed.join(F.broadcast(hot), "key", "left")
    salt = F.when(F.col("ways").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*docs.columns), F.col("ways")))
    return dealt.withColumn("salt", salt).repartition("key", "salt").drop("key", "salt", "ways")


def encode_documents(docs: DataFrame, tokenizer: str, at_once: int = 256) -> DataFrame:
    """(doc_id, ids, decoded): packed little-endian unsigned 32-bit ids, and what they decode to.

    Equal to the tokenizer's own encoding without added special tokens,
    truncation and padding, and to its decoding with special tokens kept. Null
    text counts as empty and gives no ids. Repeated rows are encoded each; an
    empty table gives no rows; extra columns are ignored. ``tokenizer`` is the
    path of a tokenizer file whose vocabulary drops white space and has no
    decoder of its own (tokens are decoded with a space between).
    ``BATCH_BYTES`` stays set for the session: the result is computed later.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task has one core; the memory of more threads would stay with the worker.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = ChunkEncoder(tokenizer)
        for whole in batches:
            for i in range(0, len(whole), at_once):
                batch = whole.slice(i, at_once)
                got = list(encoder.encode_many([t or "" for t in batch.column(1).to_pylist()]))
                texts = pa.array([encoder.decode(ids) for ids in got], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary()), texts], ["doc_id", "ids", "decoded"])
        del encoder
        release()

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return deal_by_key(picked).mapInArrow(encode, "doc_id long, ids binary, decoded string")
