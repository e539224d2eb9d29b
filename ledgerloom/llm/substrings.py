"""Substring dedup with fixed-block anchors.

Every document is cut into non-overlapping reference blocks of ``(window + 1) // 2`` words; these are the index. All
rolling windows of that size probe it. A run of ``window`` words always holds one whole block of its own document, so
two equal runs, wherever they start, meet in at least one hit. Hits are extended to every run of ``window`` words
around them; the runs that really occur twice, joined together, are the maximal exact repeats.

How the work is spread: documents are dealt into chunks of a bounded number of bytes. A chunk sends its hashes to hash
buckets and gets back the positions that are repeated. Within a chunk equal hashes are merged before they are sent, so
a passage that a third of all documents share comes to a bucket once per chunk, not once per document. No pairs of
documents are formed.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import carried, restored, row_key
from ledgerloom.llm.tokens import SECOND, WordCodes, plain_words, run_hashes

#: Text of a chunk and of a bucket's share, in bytes: what one task holds at a time, whatever the input.
CHUNK_BYTES = 6 << 20
_WIRE = "bucket long, chunk long, high binary, low binary, at binary, known binary, reference binary"
_COLUMNS = [c.split()[0] for c in _WIRE.split(", ")]


def _pack(at: np.ndarray) -> bytes:
    """Ascending positions as steps, the bytes of one weight together, so that the shuffle's compression finds zeros."""
    return np.diff(at, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel(), dtype=np.int64)


class _Chunk:
    """Words of the documents of one chunk, in a fixed order, with all their hashes in one row of numbers."""

    def __init__(self, docs: pd.DataFrame):
        self.docs = docs.sort_values(["k1", "k2"], kind="stable", ignore_index=True)
        codes = WordCodes()
        self.codes = [codes.of(plain_words(t)) for t in self.docs["text"]]
        self.start = np.concatenate([[0], np.cumsum([len(c) for c in self.codes])]).astype(np.int64)

    def hashes(self, width: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run and its position in the chunk."""
        own = [c ^ SECOND for c in self.codes] if second else self.codes
        found = [run_hashes(c, width, SECOND) if second else run_hashes(c, width) for c in own]
        at = [np.arange(len(f), dtype=np.int64) + s for f, s in zip(found, self.start)]
        return np.concatenate([np.empty(0, np.uint64), *found]), np.concatenate([np.empty(0, np.int64), *at])

    def offset(self, at: np.ndarray) -> np.ndarray:
        """Position inside the document."""
        return at - self.start[np.searchsorted(self.start, at, "right") - 1]


def _send(chunk: int, high: np.ndarray, low: np.ndarray, at: np.ndarray, reference: np.ndarray, buckets: int) -> pd.DataFrame:
    """Merge equal hashes and deal them to buckets.

    A hash met twice here is known to be repeated: its positions pass by as they are (bucket -1 - chunk), and one ``known``
    entry tells the other chunks about it. ``reference``: whether the entry belongs to the index.
    """
    order = np.lexsort((low, high))
    high, low, at, reference = high[order], low[order], at[order], reference[order]
    new = np.ones(len(high), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    group = np.cumsum(new) - 1
    known = (np.bincount(group, minlength=1) > 1)[group] if len(group) else np.empty(0, bool)
    out = []
    if known.any():
        out.append((-1 - chunk, chunk, b"", b"", _pack(np.sort(at[known])), b"", b""))
    high, low, at, known, reference = high[new], low[new], at[new], known[new], (reference | known)[new]
    # High bits choose the bucket, so hashes of a bucket differ in the bits that are sent: 32 more, or 64 with ``low``.
    bucket = ((high >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((at, bucket))
    for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(own):
            sent = (high[own].astype(np.uint32).tobytes(), low[own].tobytes(), _pack(at[own]))
            out.append((int(bucket[own[0]]), chunk, *sent, np.packbits(known[own]).tobytes(), np.packbits(reference[own]).tobytes()))
    return pd.DataFrame(out, columns=_COLUMNS)


def _repeated(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the positions, by chunk, whose hash stands there twice, at least once from the index."""
    if rows["bucket"].iloc[0] < 0:
        return rows[["chunk", "at"]]
    sizes = [len(a) // 4 for a in rows["at"]]
    at = np.concatenate([_unpack(a) for a in rows["at"]])
    known, reference = (
        np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n in zip(rows[c], sizes)])
        for c in ("known", "reference")
    )
    high, low = np.frombuffer(b"".join(rows["high"]), np.uint32), np.frombuffer(b"".join(rows["low"]), np.uint64)
    keys = (low, high) if len(low) else (high,)
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    n = int(new.sum())
    live = (np.bincount(group, minlength=n) > 1) & (np.bincount(group, reference, minlength=n) > 0)
    taken = np.flatnonzero(live[group] & ~known)
    parts = np.split(at[taken], np.searchsorted(taken, np.cumsum(sizes))[:-1])
    return pd.DataFrame([(c, _pack(p)) for c, p in zip(rows["chunk"], parts) if len(p)], columns=["chunk", "at"])


def _positions(rows: pd.DataFrame) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *map(_unpack, rows["at"])])


def _probe(block: int, buckets: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def probe(docs: pd.DataFrame) -> pd.DataFrame:
        own = _Chunk(docs)
        h, at = own.hashes(block)
        # Bucket and 32 bits are enough to find candidates; what they lead to is compared on more than 96 bits.
        sent = _send(int(docs["chunk"].iloc[0]), h, np.zeros(len(h), np.uint8), at, own.offset(at) % block == 0, buckets)
        return sent.assign(low=b"")

    return probe


def _extend(window: int, block: int, buckets: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def extend(docs: pd.DataFrame, hits: pd.DataFrame) -> pd.DataFrame:
        if not len(docs) or not len(hits):
            return pd.DataFrame([], columns=_COLUMNS)
        own = _Chunk(docs)
        first, at = own.hashes(window)
        second, _ = own.hashes(window, second=True)
        # A run is a candidate if a hit starts in its first window - block + 1 words.
        before = np.zeros(int(own.start[-1]) + 1, np.int64)
        before[1:] = np.cumsum(np.bincount(_positions(hits), minlength=int(own.start[-1])))
        candidate = before[at + window - block + 1] > before[at]
        first, second, at = first[candidate], second[candidate], at[candidate]
        return _send(int(docs["chunk"].iloc[0]), first, second, at, np.ones(len(at), bool), buckets)

    return extend


def _covered(window: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def covered(docs: pd.DataFrame, repeats: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame([], columns=["doc", "n_words", "n_removed", "kept", "spans"])
        own = _Chunk(docs)
        change = np.zeros(int(own.start[-1]) + 1, np.int64)
        at = _positions(repeats)
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
        gone = np.cumsum(change[:-1]) > 0
        rows = []
        for i, text in enumerate(own.docs["text"]):
            mark = gone[own.start[i] : own.start[i + 1]]
            words = plain_words(text)
            if mark.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
                spans = [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])]
                kept = b" ".join([w for w, m in zip(words, mark.tolist()) if not m])
            else:
                spans, kept = [], b" ".join(words)
            rows.append((own.docs["doc"][i], len(words), int(mark.sum()), kept.decode(), spans))
        return pd.DataFrame(rows, columns=["doc", "n_words", "n_removed", "kept", "spans"])

    return covered


def without_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", window: int = 35, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row ``(doc, n_words, n_removed, kept, spans)`` per input row.

    A word is removed if a run of ``window`` words that covers it also starts anywhere else, in the same document or
    another; all copies go. ``kept`` is the remaining words joined by one space, ``spans`` the removed word ranges
    ``[begin, end)``. NULL and empty texts have no words and an empty ``kept``. Rows with the same id are judged each
    on its own text; a row that is there twice is a repeat of itself. Other columns are not read. An empty table
    gives none.
    """
    block = (window + 1) // 2
    k1, k2 = row_key(doc, text)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    dealt: Column = F.pmod(F.xxhash64(F.col("k1"), F.lit("chunk")), F.lit(chunks)).alias("chunk")
    # The same shuffle of the texts serves all three readers.
    dealt_docs = docs.select(carried(doc).alias("doc"), F.col(text).alias("text"), k1, k2).select("doc", "text", "k1", "k2", dealt)
    by_chunk = dealt_docs.groupBy("chunk")

    def gathered(sent: DataFrame) -> DataFrame:
        return sent.groupBy("bucket").applyInPandas(_repeated, "chunk long, at binary")

    hits = gathered(by_chunk.applyInPandas(_probe(block, chunks), _WIRE))
    runs = by_chunk.cogroup(hits.groupBy("chunk")).applyInPandas(_extend(window, block, chunks), _WIRE)
    schema = "doc string, n_words long, n_removed long, kept string, spans array<struct<begin:int,end:int>>"
    done = by_chunk.cogroup(gathered(runs).groupBy("chunk")).applyInPandas(_covered(window), schema)
    return done.select(restored(docs, doc), "n_words", "n_removed", "kept", "spans")
