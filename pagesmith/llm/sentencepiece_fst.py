"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The transducer is compiled from the model: a normaliser (dummy prefix, white space written as the
piece model's space symbol), one path per piece, and byte-fallback arcs for characters that no piece
covers.  A text is encoded by the tropical-semiring (min, +) shortest path through its composition
with the transducer.

* Unigram models: an arc weighs the negative score of its piece.
* BPE models: states also carry the last piece; an arc weighs 0 if merging the two pieces' characters
  by rank gives back exactly these two pieces, else infinity.  A segmentation is the one that merging
  by rank produces if and only if all its neighbours are such pairs, so exactly one path has a finite
  weight and it equals the model's own encoding.  Summing merge ranks instead would not.

No piece crosses from other characters into white space, so the composition falls apart into
segments (white space and what follows it up to the next), and segments are memoised per task.
"""

from __future__ import annotations

import math
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesmith.llm.common import worker_cache

SPACE = "▁"
#: Bytes of memoised segments per Python worker (two generations), their longest, and memoised pairs of pieces.
MEMO_BYTES, MEMO_CHARS, MEMO_PAIRS = 64 << 20, 40, 300_000
#: What an entry takes besides its characters: two objects' heads and its place in the dict.
ENTRY_BYTES = 200
ROWS = 256


def model_options(model: bytes) -> dict:
    """The fields of the serialised model that the transducer follows (numbers of the public format)."""
    def fields(b: bytes):
        i = 0
        def varint():
            nonlocal i
            n = shift = 0
            while True:
                n |= (b[i] & 127) << shift
                shift += 7
                i += 1
                if b[i - 1] < 128:
                    return n
        while i < len(b):
            key = varint()
            kind = key & 7
            if kind == 0:
                yield key >> 3, varint()
            else:
                size = varint() if kind == 2 else 8 if kind == 1 else 4
                i += size
                yield key >> 3, b[i - size:i]
    out = {"type": 1, "dummy_prefix": 1, "trim": 1, "escape": 1, "charsmap": b"", "suffix": 0}
    for number, value in fields(model):
        if number == 2:  # trainer: 3 = model type (1 unigram, 2 BPE), 24 = white space as suffix
            spec = dict(fields(value))
            out |= {"type": spec.get(3, 1), "suffix": spec.get(24, 0)}
        elif number == 3:  # normaliser
            spec = dict(fields(value))
            out |= {"charsmap": spec.get(2, b""), "dummy_prefix": spec.get(3, 1), "trim": spec.get(4, 1), "escape": spec.get(5, 1)}
    return out


class Transducer:
    """The compiled transducer; ``encode`` gives piece ids as little-endian int32 bytes."""

    def __init__(self, path: str):
        import sentencepiece  # reads the model file; encoding is done here

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            self.options = model_options(f.read())
        o = self.options
        if o["type"] not in (1, 2) or o["charsmap"] or o["suffix"] or not o["escape"]:
            raise ValueError("only unigram and BPE models without character map and with white space as prefix are handled")
        n = sp.get_piece_size()
        self.byte_ids, self.out, self.ids, self.score = {}, [], {}, {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.out.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.out.append(b" \xe2\x81\x87 " if sp.is_unknown(i) else b"")
            else:
                self.out.append(piece.replace(SPACE, " ").encode())
                if not sp.is_unused(i):
                    self.ids[piece], self.score[piece] = i, sp.get_score(i)
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no byte fallback")
        self.longest = max(map(len, self.ids))
        self.bpe = o["type"] == 2
        self.crossing = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.breaks_lines = not any("\n" in p for p in self.ids)
        # the piece trie as a set of prefixes: an arc exists while the characters read so far are one
        self.prefixes = {p[:k] for p in self.ids for k in range(1, len(p) + 1)}
        self.uncovered = min(self.score.values()) - 10.0
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.memo_bytes = 0
        self.agree: dict[int, bool] = {}
        # a piece that merging its own characters doesn't give is on no finite path
        self.merges = {p: self._merges(p) for p in self.ids} if self.bpe else {}
        self.ids = {p: i for p, i in self.ids.items() if not self.bpe or self.merges[p][-1][1] == p}

    def _merges(self, piece: str) -> list[tuple[float, str, str]]:
        """Merging a piece's characters by rank: (score, first part, last part) before each merge, and at
        the end with score -infinity."""
        parts, steps = list(piece), []
        while True:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                x = self.score.get(parts[i] + parts[i + 1])
                if x is not None and x > best:
                    best, at = x, i
            steps.append((best, parts[0], parts[-1]))
            if at < 0:
                return steps
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _agrees(self, last: str, piece: str) -> bool:
        """Whether merging the characters of both by rank never joins across their boundary, that is,
        whether the arc of ``piece`` after ``last`` weighs 0.  Steps of either side run by rank."""
        left, right = self.ids.get(last), self.ids.get(piece)
        key = None if left is None or right is None else left * len(self.out) + right  # characters no piece covers have no id
        ok = self.agree.get(key)
        if ok is None:
            left, right, i, j = self.merges.get(last), self.merges.get(piece), 0, 0
            left, right = left or [(-math.inf, last, last)], right or [(-math.inf, piece, piece)]
            while ok is None:
                a, b = left[i][0], right[j][0]
                across = self.score.get(left[i][2] + right[j][1], -math.inf)
                if across > a and across >= b:
                    ok = False
                elif a == b == -math.inf:
                    ok = True
                elif a >= b:
                    i += 1
                else:
                    j += 1
            if key is not None:
                if len(self.agree) >= MEMO_PAIRS:
                    self.agree.clear()
                self.agree[key] = ok
        return ok

    def _arcs(self, s: str, j: int) -> list[str]:
        """Pieces that start at ``j``, shortest first; an uncovered character is an arc of its own."""
        found, ids, prefixes = [], self.ids, self.prefixes
        for i in range(j + 1, j + self.longest + 1):
            piece = s[j:i]
            if piece in ids:
                found.append(piece)
            elif piece not in prefixes:
                break
            if i >= len(s):
                break
        if not found or len(found[0]) > 1:
            found.insert(0, s[j])
        return found

    def _finite_path(self, s: str) -> list[str]:
        """Weights are 0 or infinite: the first finite path is the shortest one.  Depth first, longest
        piece first; a prefix of ``s`` has one finite path only, so a dead end holds for its position."""
        n, at, path, last, dead = len(s), 0, [], "", set()
        open_arcs = [self._arcs(s, 0)]
        while at < n:
            arcs = open_arcs[-1]
            while arcs:
                piece = arcs.pop()
                if last and not self._agrees(last, piece):
                    continue
                if at + len(piece) in dead:
                    continue
                path.append(piece)
                last = piece
                at += len(piece)
                if at < n:
                    open_arcs.append(self._arcs(s, at))
                break
            else:
                dead.add(at)
                open_arcs.pop()
                at -= len(path.pop())
                last = path[-1] if path else ""
        return path

    def _lightest_path(self, s: str) -> list[str]:
        """Viterbi over the positions of ``s`` (unigram models); uncovered characters weigh more than any piece."""
        n = len(s)
        best = [(0.0, "")] + [(math.inf, "")] * n
        for j in range(n):
            for piece in self._arcs(s, j):
                w = best[j][0] - self.score.get(piece, self.uncovered)
                if w < best[j + len(piece)][0]:
                    best[j + len(piece)] = (w, piece)
        out, i = [], n
        while i:
            out.append(best[i][1])
            i -= len(out[-1])
        return out[::-1]

    def shortest_path(self, s: str) -> list[str]:
        """Pieces, or single characters that no piece covers, on the lightest path over ``s``."""
        return self._finite_path(s) if self.bpe else self._lightest_path(s)

    def _segment(self, s: str) -> bytes:
        got = self.memo.get(s) or self.older.get(s)
        if got is None:
            ids = []
            for p in self.shortest_path(s):
                if p in self.ids:
                    ids.append(self.ids[p])
                else:
                    ids.extend(self.byte_ids[b] for b in p.encode())
            got = struct.pack(f"<{len(ids)}i", *ids)
        if len(s) <= MEMO_CHARS:
            if self.memo_bytes >= MEMO_BYTES // 2:  # what was used since the last turn stays
                self.memo, self.older, self.memo_bytes = {}, self.memo, 0
            self.memo_bytes += 4 * len(s) + len(got) + ENTRY_BYTES
            self.memo[s] = got
        return got

    def normalise(self, text: str) -> str:
        text = text.replace(SPACE, " ")
        if self.options["trim"]:
            text = re.sub(" +", " ", text.strip(" "))
        return " " + text if text and self.options["dummy_prefix"] else text

    def encode(self, text: str) -> bytes:
        s = self.normalise(text).replace(" ", SPACE)
        if not s:
            return b""
        if self.crossing:
            return self._segment(s)
        newline = struct.pack("<i", self.byte_ids[10])
        out = []
        for k, line in enumerate(s.split("\n") if self.breaks_lines else [s]):
            if k:
                out.append(newline)
            if SPACE + SPACE in line:
                parts = re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", line)
            else:
                first, *rest = line.split(SPACE)
                parts = [first] * (first != "") + [SPACE + x for x in rest]
            memo = self.memo
            out += [memo.get(p) or self._segment(p) for p in parts]
        return b"".join(out)

    def decode(self, ids) -> str:
        text = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.options["dummy_prefix"] and text[:1] == " " else text


def transducer(path: str) -> Transducer:
    """One compiled transducer per model file and Python worker, with its memo."""
    cache = worker_cache()
    if path not in cache:
        cache[path] = Transducer(path)
    return cache[path]


def _ship(spark, model_path: str) -> str:
    """Give every executor the model file; returns its name there."""
    spark.sparkContext.addFile(model_path)
    return model_path.rsplit("/", 1)[-1]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, n_pieces long, round_trip boolean) per row.

    ``round_trip``: decoding the ids gives the normalised text without its dummy prefix.  A null or
    empty text has no pieces (round trip holds).  Texts are encoded whole, in blocks of rows; repeated
    rows and extra columns are allowed.
    """
    name = _ship(docs.sparkSession, model_path)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = d.schema["id"].dataType.simpleString()

    def run(batches):
        t = transducer(SparkFiles.get(name))
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                texts = [x or "" for x in part.column(1).to_pylist()]
                coded = [t.encode(x) for x in texts]
                flat = np.frombuffer(b"".join(coded), "<i4")
                ends = np.cumsum([0] + [len(c) // 4 for c in coded])
                same = [t.decode(flat[a:b].tolist()) == t.normalise(x)[t.options["dummy_prefix"] if x else 0:]
                        for x, a, b in zip(texts, ends, ends[1:])]
                yield pa.record_batch([
                    part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                    pa.array(np.diff(ends), pa.int64()), pa.array(same)], ["id", "ids", "n_pieces", "round_trip"])

    out = d.mapInArrow(run, f"id {id_type}, ids array<int>, n_pieces bigint, round_trip boolean")
    return out.withColumnRenamed("id", id_col)


def decode(ids: Column, model_path: str, spark) -> Column:
    """Texts of id lists (null for null); control pieces give nothing, broken bytes U+FFFD."""
    name = _ship(spark, model_path)

    @F.pandas_udf("string")
    def text(col):
        t = transducer(SparkFiles.get(name))
        return col.map(lambda x: None if x is None else t.decode(list(x)))

    return text(ids)
