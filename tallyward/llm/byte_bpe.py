"""Byte-level BPE by tree reduction: halves are encoded on their own and joined at their border.

A text is cut into halves down to short leaves. A node joins its halves by encoding anew only a window
around their border, which grows until what lies outside provably stays as it is. Two proofs are used:

* A *seam* is a place where the pre-token pattern always ends a match, whatever stands further left or
  right (white space after something else, a letter next to a digit, ...). Text between two seams is
  encoded by itself, so tokens before the window's first seam and after its last stay.
* Inside one long run of a single kind (a thousand letters, say) there is no seam. There a sequence of
  tokens is the encoding of its bytes exactly when each pair of neighbours is the encoding of the two
  tokens' bytes (a known property of byte pair merges), so the window is done when both its edges fit.

Decoding concatenates the bytes of the tokens up the same kind of tree.
"""

import base64
import functools
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.tables import ddl, fresh, text_or_empty, without
from tallyward.llm.words import release, slices

LEAF = 256  # code points, or tokens in decoding
PIECE = 1 << 20  # bytes of text whose tokens are held at a time
# between the two characters found here, a match of the pattern always ends
_SEAM = regex.compile(r"\S\s|\p{L}[^\p{L}\s]|\p{N}[^\p{N}\s]|[^\s\p{L}\p{N}]\p{N}")
_RUN = regex.compile(r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+")
_LONG = 512  # shorter windows without a seam are simply encoded anew


class Codec:
    """Encoder and decoder for a rank file and a pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        if pattern != public_tokenizers.PATTERN:
            raise ValueError("the seams between pre-tokens are known for public_tokenizers.PATTERN only")
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {i: t for t, i in ranks.items()}
        self._fits = functools.lru_cache(1 << 16)(self._pair)

    def _pair(self, a: int, b: int) -> bool:
        return list(self.bpe._encode_single_piece(self.bytes_of[a] + self.bytes_of[b])) == [a, b]

    def encode(self, text: str, leaf: int = LEAF) -> list[int]:
        return self._node(text, 0, len(text), leaf)

    def _node(self, text: str, lo: int, hi: int, leaf: int) -> list[int]:
        if hi - lo <= max(leaf, 1):
            return self.bpe.encode_ordinary(text[lo:hi])
        mid = (lo + hi) // 2
        left, right = self._node(text, lo, mid, leaf), self._node(text, mid, hi, leaf)
        return self._join(text, lo, mid, hi, left, right)

    def _join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        a, b = self._seam_before(text, lo, mid), self._seam_after(text, mid, hi)
        keep = len(left) - self._covering(reversed(left), text[a:mid])
        drop = self._covering(right, text[mid:b])
        if b - a > _LONG and a < mid < b and _RUN.fullmatch(text[a:b]):
            return left[:keep] + self._inside(left[keep:], right[:drop]) + right[drop:]
        return left[:keep] + self.bpe.encode_ordinary(text[a:b]) + right[drop:]

    def _covering(self, tokens, part: str) -> int:
        """How many of the tokens make up the text next to the border."""
        size, n = len(part.encode()), 0
        for t in tokens:
            if size <= 0:
                break
            size -= len(self.bytes_of[t])
            n += 1
        return n

    @staticmethod
    def _seam_before(text: str, lo: int, mid: int) -> int:
        """The last seam in ``text[lo:mid]``, which what follows can't undo."""
        width = 64
        while True:
            begin = max(lo, mid - width)
            at = None
            for found in _SEAM.finditer(text, begin, mid, overlapped=True):
                at = found.start() + 1
            if at is not None:
                return at
            if begin == lo:
                return lo
            width *= 4

    @staticmethod
    def _seam_after(text: str, mid: int, hi: int) -> int:
        width = 64
        while True:
            end = min(hi, mid + width)
            found = _SEAM.search(text, mid, end)
            if found:
                return found.start() + 1
            if end == hi:
                return hi
            width *= 4

    def _inside(self, left: list[int], right: list[int]) -> list[int]:
        """Two encodings inside one run, joined: the window grows until both its edges fit."""
        k = 4
        while True:
            a, b = max(0, len(left) - k), min(len(right), k)
            window = list(self.bpe._encode_single_piece(b"".join(self.bytes_of[t] for t in left[a:] + right[:b])))
            if (a == 0 or self._fits(left[a - 1], window[0])) and (b == len(right) or self._fits(window[-1], right[b])):
                return left[:a] + window + right[b:]
            k *= 2

    def decode(self, ids: list[int], leaf: int = LEAF) -> bytes:
        if len(ids) <= leaf:
            return b"".join([self.bytes_of[i] for i in ids])
        mid = len(ids) // 2
        return self.decode(ids[:mid], leaf) + self.decode(ids[mid:], leaf)


@functools.lru_cache(4)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process."""
    return Codec(path, pattern)


ADDED = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}


def encode(docs: DataFrame, path: str, pattern: str, leaf: int = LEAF, ids: bool = False) -> DataFrame:
    """Adds ``n_tokens, ids_sha256, decoded_sha256`` (and ``ids array<int>`` on demand) to every row.

    Whole texts, a null text as an empty one (0 tokens, digests of nothing); each match of ``pattern`` is encoded by
    itself, no special tokens. ``ids_sha256`` is over little-endian 32-bit ids, ``decoded_sha256`` over the decoded
    bytes. Other columns pass; an input column of an added name is replaced. Rows stay where they are: no shuffle.
    """
    added = ADDED | ({"ids": pa.list_(pa.int32())} if ids else {})
    rows = without(docs, *added)
    source = fresh(rows, "_text")

    def run(batches):
        c = codec(path, pattern)
        for batch in (part for whole in batches for part in slices(whole, source, PIECE)):
            out = {name: [] for name in added}
            for text in batch.column(source):
                tokens = c.encode(text.as_py(), leaf)
                out["n_tokens"].append(len(tokens))
                out["ids_sha256"].append(hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(c.decode(tokens, leaf)).hexdigest())
                if ids:
                    out["ids"].append(np.array(tokens, np.int32))
            kept = [x for x in batch.schema.names if x != source]
            yield pa.RecordBatch.from_arrays(
                [batch.column(x) for x in kept] + [pa.array(out[x], t) for x, t in added.items()], names=kept + list(added))
        release()

    schema = f"{ddl(rows)}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return rows.withColumn(source, text_or_empty()).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    return encode(docs.select(F.col("doc_id"), text_or_empty().alias("text")), path, pattern).drop("text")
