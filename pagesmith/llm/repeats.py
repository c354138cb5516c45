"""Removal of repeated passages with repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document.  Every word goes that a window covers whose words also start
earlier (order: id, then place in the document).  Windows are judged on the input.

1. *Pack*: texts are written once as compressed blocks of bounded size.
2. *Confirm*: each window is represented by the phrase of ``PHRASE`` words in it that has the least hash, so equal windows
   have equal phrases, and neighbouring windows mostly share theirs: about one word in seven begins a phrase.  Phrases
   that represent windows at two places or more are confirmed; all other windows are unique.
3. *Locate*: the phrases are sharded by block, as a block can only hold its own.  Each shard is compiled to an Aho-Corasick
   automaton, and the block's documents are streamed through it to find every occurrence.  What an
   occurrence stands for is named by its context, a hash of all the words of its windows: the first occurrence of a
   (phrase, context) keeps its windows, later ones lose them.
4. *Edges*: only phrases with several contexts can have windows that equal one another beyond that.  The windows of the
   first occurrence of each such context are compared one by one.
5. *Remove*: every block learns which of its contexts and windows have been earlier, repeats inside the block are seen
   there, and the words that are left are put together.

Rows that meet in one group are at most one per block, whatever the number of copies: each block reports its own
first occurrence.  Equality is that of 128-bit hashes (64 bits for phrases, where a collision only costs work).
"""

from __future__ import annotations

import hashlib
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagesmith.llm.common import table

WINDOW, PHRASE = 20, 6
#: Bytes of text per block; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base % (1 << 64), _U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


def _spelt(codes: np.ndarray, n_codes: int) -> tuple[str, int]:
    """Word numbers below ``n_codes`` as one string, and the characters of each: six bits a character, the highest first.
    Each place of a word has characters of its own, so no match begins or ends inside a word."""
    size = max(1, -(-(n_codes - 1).bit_length() // 6)) if n_codes else 1
    places = np.arange(size)
    letters = (codes.astype(np.int64)[:, None] >> 6 * (size - 1 - places) & 63) + 64 * places + 1
    return letters.astype("<u4").tobytes().decode("utf-32-le"), size


class Block:
    """The words of a block's documents, hashes of any run of them, and the phrases of their windows."""

    def __init__(self, ids: list, texts: list[bytes], window: int = WINDOW, phrase: int = PHRASE):
        self.ids, self.window, self.phrase = ids, window, phrase
        self.words = [text.split() for text in texts]
        sizes = np.fromiter(map(len, self.words), np.int64, len(texts))
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(texts) else 0
        self.n, self.starts = n, ends - sizes
        self.doc = np.repeat(np.arange(len(ids)), sizes)
        self.doc_end = np.repeat(ends, sizes)
        # order of (id, place in the document) as one number
        order = {x: k for k, x in enumerate(sorted(set(ids), key=lambda x: (x is not None, x.encode() if isinstance(x, str) else x or 0)))}
        rank = np.fromiter((order[x] for x in ids), np.int64, len(ids))
        self.place = np.arange(n) - np.repeat(self.starts, sizes)
        self.key = (np.repeat(rank, sizes) << 40) + self.place

        distinct = pa.array(chain.from_iterable(self.words), pa.large_binary()).dictionary_encode()
        digests = b"".join(map(xxhash.xxh3_128_digest, distinct.dictionary.to_numpy(zero_copy_only=False)))
        lanes, at = np.frombuffer(digests, ">u8").reshape(-1, 2).astype(_U), distinct.indices.to_numpy(zero_copy_only=False)
        power, self.inverse = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        self.sums = [np.concatenate([np.zeros(1, _U), np.cumsum(lanes[at, k] * power[:n], dtype=_U)]) for k in (0, 1)]
        self.codes, self.n_codes = at, len(distinct.dictionary)
        self._anchor()

    def hash(self, lane: int, start: np.ndarray, size) -> np.ndarray:
        """Hashes of ``size`` words from ``start`` on."""
        c = self.sums[lane]
        return _mix((c[start + size] - c[start]) * self.inverse[start] + np.asarray(size).astype(_U))

    def _anchor(self) -> None:
        """``at``: words that begin the least phrase of some window; ``low``, ``high``: the first and last such window."""
        n, w, k = self.n, self.window, self.phrase
        whole = np.flatnonzero(self.doc_end[:max(0, n - w + 1)] - np.arange(max(0, n - w + 1)) >= w)
        self.windows = whole
        if not len(whole):
            self.at = self.low = self.high = whole
            return
        # a window holds w - k + 1 phrases; all of a whole window's lie in its document
        least = sliding_window_view(self.hash(0, np.arange(n - k + 1), k), w - k + 1)[whole].argmin(axis=1) + whole
        new = np.flatnonzero(np.concatenate([[True], np.diff(least) != 0]))
        self.at, self.low, self.high = least[new], whole[new], whole[np.append(new[1:], len(whole)) - 1]

    def firsts(self, *lanes: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Indices of the first row by ``key`` of every distinct combination of the lanes."""
        order = np.lexsort((key, *lanes))
        new = np.zeros(len(order), bool)
        new[:1] = True
        for x in lanes:
            new[1:] |= x[order][1:] != x[order][:-1]
        return order[new]

    def located(self, patterns: list[int]) -> np.ndarray:
        """Which anchors are occurrences of the phrases that begin at the words ``patterns``, found by an automaton."""
        import ahocorasick

        shard, k, hit = ahocorasick.Automaton(ahocorasick.STORE_LENGTH), self.phrase, np.zeros(self.n + 1, bool)
        text, size = _spelt(self.codes, self.n_codes)
        for p in patterns:
            shard.add_word(text[p * size:(p + k) * size])
        shard.make_automaton()
        # the documents follow one another: a match that runs into the next one begins no phrase of a window
        ends = np.fromiter((e for e, _ in shard.iter(text)), np.int64)
        hit[(ends + 1) // size - k] = True
        return np.flatnonzero(hit[self.at])

    def contexts(self, which: np.ndarray) -> np.ndarray:
        """Hashes that equal anchors share if and only if all their windows are equal."""
        at, low = self.at[which], self.low[which]
        return _mix(self.hash(1, low, self.high[which] + self.window - low) + (at - low).astype(_U))

    def windows_of(self, at) -> np.ndarray:
        """Windows whose least phrase begins at the words ``at``."""
        which = np.searchsorted(self.at, np.asarray(at, np.int64))
        low, size = self.low[which], self.high[which] - self.low[which] + 1
        return np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())

    def covered(self, later: np.ndarray) -> np.ndarray:
        """Which words go: those of windows that equal a window of ``later`` or an earlier one of this block."""
        t = self.windows
        first, second, key = self.hash(0, t, self.window), self.hash(1, t, self.window), self.key[t]
        order = np.lexsort((second, first))
        new = np.ones(len(order), bool)
        new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        least = np.minimum.reduceat(key[order], np.flatnonzero(new)) if len(order) else key
        least[group[np.searchsorted(t, later)]] = -1
        starts = np.zeros(self.n + 1, np.int64)
        starts[t[key > least[group]]] = 1
        sums = np.cumsum(starts)[:-1]
        return sums - np.concatenate([np.zeros(self.window, np.int64), sums])[:len(sums)] > 0


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, ids, ends, texts): consecutive rows of the input, their texts compressed together."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["block", "ids", "ends", "texts"]

    def run(batches):
        press, block = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId() << 32
        id_type, ids, texts, size = None, [], [], 0

        def packed():
            ends = np.cumsum([len(t) for t in texts])
            return pa.record_batch([pa.array([block], pa.int64()), pa.array([ids], pa.list_(id_type)),
                                    pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([press.compress(b"".join(texts))], pa.binary())], names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, x in zip(batch.column(0), batch.column(1).cast(pa.large_binary())):
                text = x.as_py() or b""
                if texts and size + len(text) > block_bytes:
                    yield packed()
                    block, ids, texts, size = block + 1, [], [], 0
                ids.append(i.as_py())
                texts.append(text)
                size += len(text)
        if texts:
            yield packed()

    id_type = d.schema["id"].dataType.simpleString()
    return d.mapInArrow(run, f"block bigint, ids array<{id_type}>, ends array<bigint>, texts binary")


def _per_block(rows: DataFrame, work, schema: str, window: int, phrase: int) -> DataFrame:
    """``work(block number, Block, *further columns)`` gives a record batch for every packed row."""
    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                number, ids, ends, texts, *more = (batch.column(c)[k] for c in range(batch.num_columns))
                whole, ends = unpress.decompress(texts.as_py()), ends.as_py()
                block = Block(ids.as_py(), [whole[a:b] for a, b in zip([0, *ends], ends)], window, phrase)
                yield work(number.as_py(), block, *(np.array(x.as_py() or [], np.int64) for x in more))

    return rows.mapInArrow(run, schema)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _lists(rows: DataFrame, out: str) -> DataFrame:
    """Word numbers by block; a block's list is bounded by its words."""
    return rows.groupBy("block").agg(F.collect_list("at").alias(out))


def _not_first(rows: DataFrame, *group: str) -> DataFrame:
    """``rows`` with ``later``: whether an earlier (id, start) has the same group.  A group has one row per block at most."""
    place = F.struct("id", "start")
    return rows.withColumn("later", place > F.min(place).over(Window.partitionBy(*group)))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, phrase: int = PHRASE,
                   block_bytes: int = BLOCK_BYTES, texts: bool = True) -> DataFrame:
    """(id, n_words, n_removed, spans, kept_sha256[, text]) per row: the numbers [start, end) of the words that go, and the words
    that stay, joined by one space (``text``, and its SHA-256).

    * A null or empty text has no words.  A text shorter than a window loses nothing.
    * Rows of equal id are one place in the order: equal windows at equal starts of them are not earlier than one another,
      so repeated rows lose the same words, and none by each other.  A null id comes first.
    * Texts are read whole; one longer than a block makes a block alone.  Extra columns are ignored; no rows give none.
    """
    blocks = table(pack(docs, id_col, text_col, block_bytes), "repeats-blocks")
    id_type = blocks.schema["ids"].dataType.elementType
    arrow_type, id_name = to_arrow_type(id_type), id_type.simpleString()

    def phrases(number, b):
        hashes = b.hash(0, b.at, phrase)
        _, first, n = np.unique(hashes, return_index=True, return_counts=True)
        return pa.record_batch([_signed(hashes[first]), pa.array(np.full(len(first), number)), pa.array(b.at[first]), pa.array(n > 1)], ["phrase", "block", "at", "many"])

    found = _per_block(blocks, phrases, "phrase bigint, block bigint, at bigint, many boolean", window, phrase)
    several = (F.count("*").over(Window.partitionBy("phrase")) > 1) | F.col("many")
    confirmed = found.withColumn("several", several).where("several")

    def row_ids(b, at):
        return pa.array([b.ids[d] for d in b.doc[at].tolist()], arrow_type)

    def locate(number, b, patterns):
        which = b.located(patterns.tolist())
        hashes, contexts = b.hash(0, b.at[which], phrase), b.contexts(which)
        first = b.firsts(hashes, contexts, key=b.key[b.low[which]])
        low, at = b.low[which][first], b.at[which][first]
        return pa.record_batch([_signed(hashes[first]), _signed(contexts[first]), pa.array(np.full(len(first), number)), pa.array(at),
                                row_ids(b, low), pa.array(b.place[low])], ["phrase", "context", "block", "at", "id", "start"])

    occurrences = _per_block(blocks.join(_lists(confirmed, "patterns"), "block"), locate,
                             f"phrase bigint, context bigint, block bigint, at bigint, id {id_name}, start bigint", window, phrase)
    occurrences = table(_not_first(occurrences, "phrase", "context").select("phrase", "context", "block", "at", "later"), "repeats-occurrences")

    edge = occurrences.groupBy("phrase").agg((F.min("context") != F.max("context")).alias("edge")).where("edge").select("phrase")
    firsts = occurrences.where("not later").join(edge, "phrase", "left_semi")

    def compare(number, b, anchors):
        t = b.windows_of(anchors)
        one, two = b.hash(0, t, window), b.hash(1, t, window)
        first = b.firsts(one, two, key=b.key[t])
        t = t[first]
        return pa.record_batch([_signed(one[first]), _signed(two[first]), pa.array(np.full(len(t), number)), pa.array(t), row_ids(b, t),
                                pa.array(b.place[t])], ["h1", "h2", "block", "at", "id", "start"])

    windows = _per_block(blocks.join(_lists(firsts, "anchors"), "block"), compare,
                         f"h1 bigint, h2 bigint, block bigint, at bigint, id {id_name}, start bigint", window, phrase)
    gone = _lists(_not_first(windows, "h1", "h2").where("later"), "windows")
    later = _lists(occurrences.where("later"), "anchors")

    def remove(number, b, anchors, later_windows):
        out = b.covered(np.concatenate([b.windows_of(anchors), later_windows]))
        rows = []
        for start, words in zip(b.starts.tolist(), b.words):
            off = out[start:start + len(words)]
            kept = b" ".join(compress(words, ~off))
            edges = np.flatnonzero(np.diff(off, prepend=False, append=False)).reshape(-1, 2)
            spans = [{"start": s, "end": e} for s, e in edges.tolist()]
            rows.append((len(words), int(off.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None))
        n, removed, spans, sha, kept = map(list, zip(*rows))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        columns = [pa.array(b.ids, arrow_type), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(sha)]
        return pa.record_batch(columns + [pa.array(kept)] * texts, ["id", "n_words", "n_removed", "spans", "kept_sha256"] + ["text"] * texts)

    schema = f"id {id_name}, n_words bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept_sha256 string"
    known = later.join(gone, "block", "full")
    out = _per_block(blocks.join(known, "block", "left"), remove, schema + ", text string" * texts, window, phrase)
    return out.withColumnRenamed("id", id_col)
