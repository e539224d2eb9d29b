"""Language-model scores from a probabilistic suffix tree over words.

A state of the tree is a context of up to ``DEPTH`` words. Its next-word distribution is smoothed with the one of the context
that is a word shorter, down to add-one counts of single words: ``p(w|s) = (c(sw) + PRIOR p(w|shorter s)) / (c(s) + PRIOR)``. A
context is looked at if it occurs ``LEAST`` times, and retained if its divergence from the shorter one, summed over its
occurrences with each occurrence left out of the counts in turn, is ``DIVERGENCE`` nats or more; a state needs all its
shorter contexts. A word is scored by the longest retained suffix of what stands before it.

Documents are turned into word codes once and dealt into chunks of about ``CHUNK`` words. A chunk asks for each distinct n-gram
it holds once: sorted hashes go in slices to shards of the hash space, a shard adds up what all chunks hold, and each slice
comes back as totals in the same order. Word pairs and longer n-grams are only asked for after contexts that turned out
frequent, and not if a part of them is held by no other chunk: then the chunk's own count is the total. The sums of the
divergence test take the same way and come back as one bit each; a longer context is only tested if the shorter one is
retained. No table of the model is ever held by one task or sent to all: what is exchanged grows with the distinct n-grams of
the chunks. Chunks and answers are tables bucketed by chunk, so the words themselves are not shuffled; what an exchange wrote
on its way is deleted once its answers are written.

Single words are known by 64 bits of hash, longer n-grams by 48.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import carried, restored, saved
from ledgerloom.llm.tokens import WordCodes, mix, run_hashes
from ledgerloom.session import delete_path, scratch_path

DEPTH = 2
LEAST = 24
PRIOR = 128.0
DIVERGENCE = 3.0
CHUNK = 3 << 19
#: Distinct n-grams that a shard holds at about.
SHARD = 1 << 22
#: Per level the sorted hashes that a chunk asks for, and what it holds of each.
Request = Iterator[tuple[int, np.ndarray, np.ndarray]]
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Bits by which n-grams of two and more words are known; the rest is cut off.
_KNOWN = np.uint64(((1 << 48) - 1) << 16)
#: Gains are added up as whole sixteenths of a nat, so their order does not matter.
_PART = 16
#: Spark then deletes the shuffle files of a query at its end, not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Closes every text; no word holds white space.
_END = b"\n"


def _packed(values: np.ndarray) -> bytes:
    """Eight-byte values, byte by byte and compressed: the bytes that vary little become small."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T))


def _unpacked(data: bytes, kind: type = np.uint64) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).reshape(-1).view(kind)


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=np.uint64)


def held_out(doc: str) -> Column:
    """Every seventh document by the checksum of its id is kept away from learning. A NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def tokens_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space in lower case (A-Z only), and the end."""
    return [*(text or "").encode().translate(_LOWER).split(), _END]


_CHUNK_ROW = "chunk long, docs array<string>, held array<boolean>, sizes array<long>, vocabulary binary, words binary"


def _dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of whole documents, numbered by task and turn."""
    codes, part, turn = WordCodes(), TaskContext.get().partitionId(), 0
    docs, held, texts, size = [], [], [], 0

    def done() -> pd.DataFrame:
        # Frequent words first: their numbers are small, and most words of a text are frequent ones.
        vocabulary, words = _distinct(np.concatenate(texts))
        order = np.argsort(-np.bincount(words, minlength=len(vocabulary)), kind="stable")
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.arange(len(order), dtype=np.uint64)
        row = [(part << 24) + turn, docs, held, [len(t) for t in texts], _packed_keys(vocabulary[order]), _packed(rank[words])]
        return pd.DataFrame([row], columns=["chunk", "docs", "held", "sizes", "vocabulary", "words"])

    for batch in batches:
        for doc, out, text in zip(batch["doc"], batch["held"], batch["text"]):
            own = codes.of(tokens_of(text))
            docs.append(doc)
            held.append(bool(out))
            texts.append(own)
            size += len(own)
            if size >= CHUNK:
                yield done()
                docs, held, texts, size, turn = [], [], [], 0, turn + 1
    if docs:
        yield done()


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and which of them each is."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    first = np.ones(len(hashes), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(hashes), np.int32)
    inverse[order] = np.cumsum(first, dtype=np.int32) - 1
    return ordered[first], inverse


class Chunk:
    """The words of a chunk with what was answered so far.

    ``counts[k][i]`` is the count of the ``k + 1`` words that end at place ``i``, 0 where nobody asked; ``alone[k][i]``: no
    other chunk holds them. ``states[k][i]``: the ``k`` words before place ``i`` and all shorter contexts are retained.
    """

    def __init__(self, row: dict, answers: list[np.ndarray], verdicts: list[np.ndarray] = ()):
        self.sizes, self.vocabulary = np.asarray(row["sizes"], np.int64), _unpacked_keys(row["vocabulary"])
        self.words = _unpacked(row["words"], np.int64).astype(np.int32)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.place = np.arange(len(self.words), dtype=np.int32) - np.repeat(self.starts.astype(np.int32), self.sizes)
        self.learned = np.repeat(~np.asarray(row["held"], bool), self.sizes)
        self.counts: list[np.ndarray] = []
        self.alone: list[np.ndarray] = []
        for level, answer in enumerate(answers):
            at, _, inverse, own, known = self.asked(level)
            own[~known] = np.where(answer > 0, answer - 1, own[~known])
            known[~known] = answer == 0
            # Half the memory where it will do.
            counts = np.zeros(len(self.words), np.int32 if own.max(initial=0) < 1 << 30 else np.int64)
            alone = np.zeros(len(self.words), bool)
            counts[at], alone[at] = own[inverse], known[inverse]
            self.counts.append(counts)
            self.alone.append(alone)
        self.states = [np.ones(len(self.words), bool)]
        for level, verdict in enumerate(verdicts, 1):
            at, _, inverse = self.contexts(level)
            state = np.zeros(len(self.words), bool)
            state[at] = verdict[inverse] > 0
            self.states.append(state)

    def grams(self, length: int) -> np.ndarray:
        """Hash of the ``length`` words that end at each place; places too near the start hold none worth reading."""
        out = np.zeros(len(self.words), np.uint64)
        out[length - 1 :] = mix(run_hashes(self.vocabulary[self.words], length) ^ np.uint64(length)) & _KNOWN
        return out

    def before(self, level: int) -> np.ndarray:
        """Count of the ``level`` words before each place; 0 where there are fewer."""
        out = np.zeros_like(self.counts[level - 1])
        out[1:] = self.counts[level - 1][:-1]
        out[self.place < level] = 0
        return out

    def asked(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The n-grams of ``level + 1`` words worth counting.

        Places, distinct sorted hashes, for each place which, the learned occurrences here, and whether they are all there are
        because this chunk alone holds the n-gram's start or end. The other hashes are asked for.
        """
        if level == 0:
            keys = mix(mix(self.vocabulary) ^ np.uint64(1))
            order = np.argsort(keys)
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            at, keys, inverse = np.arange(len(self.words)), keys[order], rank[self.words]
        else:
            at = np.flatnonzero(self.before(level) >= LEAST).astype(np.int32)
            keys, inverse = _distinct(self.grams(level + 1)[at])
        known = np.zeros(len(keys), bool)
        if level:
            alone = self.alone[level - 1]
            known[inverse[alone[at] | alone[at - 1]]] = True
        return at, keys, inverse, np.bincount(inverse, self.learned[at], len(keys)), known

    def contexts(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, distinct sorted hashes, and for each place which: the frequent contexts of ``level`` words after retained ones."""
        at = np.flatnonzero(self.states[level - 1] & (self.before(level) >= LEAST)).astype(np.int32)
        if level > 1:
            return at, *_distinct(self.grams(level)[at - 1])
        # Single words by the vocabulary, which is shorter.
        words = self.words[at - 1]
        used = np.flatnonzero(np.bincount(words, minlength=len(self.vocabulary)))
        keys, inverse = _distinct(mix(run_hashes(self.vocabulary[used], 1) ^ np.uint64(1)) & _KNOWN)
        which = np.zeros(len(self.vocabulary), np.int32)
        which[used] = inverse
        return at, keys, which[words]


def _base(counts: np.ndarray, total: int, distinct: int) -> np.ndarray:
    return (counts + 1) / (total + distinct + 1)


def divergences(chunk: Chunk, level: int, total: int, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """The contexts of ``level`` words, and what they gain on the shorter ones over the chunk's learned occurrences."""
    p = _base(np.maximum(chunk.counts[0] - 1, 0), max(total - 1, 0), distinct)
    for shorter in range(1, level + 1):
        at, keys, inverse = chunk.contexts(shorter)
        was = p[at]
        p[at] = (np.maximum(chunk.counts[shorter][at] - 1, 0) + PRIOR * was) / (np.maximum(chunk.before(shorter)[at] - 1, 0) + PRIOR)
    gain = np.where(chunk.learned[at], np.log(p[at] / was), 0.0)
    return keys, np.rint(np.bincount(inverse, gain, len(keys)) * _PART)


def probabilities(chunk: Chunk, total: int, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """``(by single words, by the longest states)``: the probability of the word at each place."""
    base = _base(chunk.counts[0], total, distinct)
    p = base.copy()
    for level, state in enumerate(chunk.states[1:], 1):
        p[state] = (chunk.counts[level][state] + PRIOR * p[state]) / (chunk.before(level)[state] + PRIOR)
    return base, p


#: Levels: counts of ``level + 1`` words, below 0 gains of contexts of ``-level`` words.
_SLICE = "level int, shard int, chunk long, keys binary, own binary"
_TOTALS = "level int, shard int, chunk long, answer binary, n long"


def _slices(level: int, chunk: int, keys: np.ndarray, own: np.ndarray, bits: int) -> pd.DataFrame:
    """Cut sorted hashes by their first ``bits``; empty slices are left out."""
    ends = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.empty(0, int)
    ends = np.concatenate([[0], ends, [len(keys)]])
    rows = [
        (level, i, chunk, _packed_keys(keys[a:b]), _packed(own[a:b].astype(np.int64)))
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])) if b > a
    ]
    return pd.DataFrame(rows, columns=["level", "shard", "chunk", "keys", "own"])


def _totals(group: pd.DataFrame) -> pd.DataFrame:
    """Add up what the chunks hold of each hash; every slice is answered in its order. A row without a chunk counts the hashes.

    Counts come back with one added, or as 0 if a single chunk asked, whose own count is the total. Gains (levels below 0) come
    back as 1 if the context is retained.
    """
    group = group.sort_values("chunk")
    keys = [_unpacked_keys(k) for k in group["keys"]]
    every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(every), np.int64)
    np.add.at(sums, inverse, np.concatenate([_unpacked(v, np.int64) for v in group["own"]]))
    n = int((sums > 0).sum())
    if group["level"].iloc[0] < 0:
        sums = (sums >= DIVERGENCE * _PART).astype(np.int64)
    else:
        sums = np.where(np.bincount(inverse, minlength=len(every)) > 1, sums + 1, 0)
    ends = np.cumsum([len(k) for k in keys])
    out = group[["level", "shard", "chunk"]].assign(answer=[_packed(sums[i]) for i in np.split(inverse, ends[:-1])], n=0)
    return pd.concat([out, out.iloc[:1].assign(chunk=-1, answer=b"", n=n)], ignore_index=True)


class _Exchange:
    """Chunks and the answers they got, as tables bucketed by chunk, which join without a shuffle of the words."""

    def __init__(self, docs: DataFrame, doc: str, text: str):
        held = docs.select(carried(doc).alias("doc"), held_out(doc).alias("held"), F.col(text).alias("text"))
        self.spark, self.tables, self.answers, self.buckets = docs.sparkSession, [], {}, 8
        self.buckets = max(8, min(100_000, 2 * held.rdd.getNumPartitions()))
        self.chunks = self.bucketed(held.mapInPandas(_dealt, _CHUNK_ROW), "chunks")
        words = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)
        learned = F.aggregate(F.arrays_zip("sizes", "held"), F.lit(0).cast("long"), lambda a, x: a + F.when(x["held"], 0).otherwise(x["sizes"]))
        every, self.total = self.chunks.agg(F.sum(words), F.sum(learned)).first()
        self.total = self.total or 0
        self.bits = max(0, -(-2 * (every or 0) // SHARD) - 1).bit_length()

    def bucketed(self, df: DataFrame, name: str) -> DataFrame:
        table = f"{name}_{uuid.uuid4().hex}"
        writer = df.write.bucketBy(self.buckets, "chunk").sortBy("chunk").format("parquet").option("path", scratch_path(self.spark, name))
        writer.saveAsTable(table)
        self.tables.append(table)
        return self.spark.table(table)

    def rows(self) -> DataFrame:
        out = self.chunks
        for name, answer in self.answers.items():
            out = out.join(answer.withColumnRenamed("answer", name), "chunk", "left")
        return out

    def ask(self, name: str, request: Callable[[dict], Request]) -> int:
        """Send what ``request`` gives per chunk, and keep the answers as ``name``. How many of the hashes have a sum above 0."""
        bits = self.bits

        def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.to_dict("records"):
                    for level, keys, own in request(row):
                        yield _slices(level, row["chunk"], keys, own, bits)

        found, path = self.rows().mapInPandas(send, _SLICE).groupBy("level", "shard"), scratch_path(self.spark, "totals")
        found.applyInPandas(_totals, _TOTALS).write.parquet(path)
        found = self.spark.read.schema(_TOTALS).parquet(path)
        # All slices of a chunk: as many hashes as the chunk holds itself.
        per = found.where("chunk >= 0").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("level", "shard", "answer"))).alias("answer"))
        self.answers[name] = self.bucketed(per, name)
        n = found.where("chunk < 0").agg(F.sum("n")).first()[0] or 0
        delete_path(self.spark, path)
        return n

    def close(self) -> None:
        """Forget the tables' names; the files go with the job's other scratch tables."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def _answer(row: dict, name: str, level: int) -> np.ndarray:
    """The answers of one level, all slices in order."""
    found = row[name] if row[name] is not None else []
    parts = [_unpacked(x["answer"], np.int64) for x in found if x["level"] == level]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _chunk(row: dict, counts: int, gains: int) -> Chunk:
    """A chunk with so many levels of counts and of verdicts on contexts; exchange ``k`` has counts ``k`` and gains ``k - 1``."""
    answers = [_answer(row, f"exchange{k}", k) for k in range(counts)]
    return Chunk(row, answers, [_answer(row, f"exchange{k + 1}", -k) for k in range(1, gains + 1)])


def text_scores(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row ``(doc, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per input row.

    Words are runs between ASCII white space with A-Z in lower case; an end follows each text's last word and counts as one.
    The model learns from all texts that are not held out. ``n_known``: tokens that occur there; ``base_score``: log10 of the
    text's probability by add-one counts of single words; ``score``: by the suffix tree.

    A NULL text is an empty one: it has the end only. Rows with the same id are scored each on its own, repeated rows count
    as often as they come. A NULL id is not held out. Other columns are not read. An empty table gives none; if all rows are
    held out, every word is unknown and has probability 1 / (0 + 0 + 1).
    """
    spark = docs.sparkSession
    cleanup = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        found, total = _scored(docs, doc, text)
    finally:
        spark.conf.unset(_CLEANUP) if cleanup is None else spark.conf.set(_CLEANUP, cleanup)
    return found.select(
        restored(docs, doc), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), F.round("base_score", 9).alias("base_score"),
        F.round("score", 9).alias("score"),
    )


def _scored(docs: DataFrame, doc: str, text: str) -> tuple[DataFrame, int]:
    """The scores by id as text, and how many words were learned from."""
    exchange = _Exchange(docs, doc, text)
    total, distinct = exchange.total, 0

    def request(step: int, total: int, distinct: int) -> Callable[[dict], Request]:
        def of(row: dict) -> Request:
            chunk = _chunk(row, min(step, DEPTH + 1), max(0, step - 2))
            if step <= DEPTH:
                _, keys, _, own, known = chunk.asked(step)
                yield step, keys[~known], own[~known]
            if step > 1:
                yield 1 - step, *divergences(chunk, step - 1, total, distinct)

        return of

    for step in range(DEPTH + 2):
        n = exchange.ask(f"exchange{step}", request(step, total, distinct))
        distinct = distinct if step else n

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                chunk = _chunk(row, DEPTH + 1, DEPTH)
                base, p = probabilities(chunk, total, distinct)
                sums = [np.add.reduceat(np.log10(x), chunk.starts) for x in (base, p)]
                known = np.add.reduceat(chunk.counts[0] > 0, chunk.starts, dtype=np.int64)
                yield pd.DataFrame({
                    "doc": row["docs"], "held_out": row["held"], "n_tokens": chunk.sizes, "n_known": known, "base_score": sums[0], "score": sums[1]
                })

    found = exchange.rows().mapInPandas(score, "doc string, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    found = saved(found, "scores")
    exchange.close()
    return found, total
