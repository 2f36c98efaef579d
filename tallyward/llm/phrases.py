"""Phrase collocation mining by Rabin-Karp fingerprints.

1. Texts are written once in blocks of bounded size. A block lowers its words into one buffer; prefix polynomials over
   its bytes give the fingerprint of every run of 1 to 4 words by one subtraction and one product.
2. Fingerprints leave the block in one piece per hash range, sorted, equal ones as one with a count; the block's number is
   the pointer to where they occur. A hash range adds them up and points back to the blocks that hold a
   fingerprint found often enough.
3. Only there the text is looked at again: a block finds the places of these fingerprints and counts the phrases
   themselves. Equal fingerprints of different phrases part here, so the counts are exact; what is rare is never made
   into a string.
4. Phrases are few from here on: cuts, scores and containment are joins and aggregates.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm import words as W
from tallyward.llm.tables import stored

LEAST, LONGEST, TOP = 30, 4, 2000
SCALE = 2_000_000
SHARES = 64
CONTAINED = 80  # percent of a phrase's occurrences that lie in one longer phrase
BLOCK_BYTES = 4 << 20  # of text
RANGE_BYTES = 4 << 20  # of text for each hash range
MOST_BITS = 20
UNKNOWN = "und"
SINGLE, SHARED = 0, 1
# A fingerprint is told by its hash range and so many more bits. Ranges follow the size of the text, so few rare phrases
# share a value with a frequent one; those that do are told apart in the text.
LOW = 24
BYTES = LOW // 8

_BLOCKS = "block long, size long, lang string, text string"
_SENT = "bucket int, block long, kind int, payload binary"
_BACK = "block long, bucket int, payload binary"
_COUNTED = "lang string, phrase string, words int, n long"

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = W.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))  # of each byte


def _edges(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of equal values."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return begins, np.append(begins[1:], len(values))


def _packed(values: np.ndarray) -> np.ndarray:
    """The lowest ``BYTES`` bytes of each value, a row each."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :BYTES])


def _unpacked(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data) // BYTES, 4), np.uint8)
    out[:, :BYTES] = data.reshape(-1, BYTES)
    return out.view("<u4").ravel()


def _blocks(most_bytes: int):
    def run(batches):
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in W.slices(batch, "text", most_bytes):
                at += 1
                text = part.column("text")
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(part.num_rows, at)), pc.cast(pc.binary_length(text), pa.int64()), part.column("lang"), text,
                ], names=["block", "size", "lang", "text"])

    return run


class _Block:
    """The words of one block in one buffer, lower case, a blank after each, and the fingerprints of their runs."""

    def __init__(self, table: pa.Table, longest: int):
        self.lang = table.column("lang").combine_chunks().dictionary_encode()
        found = W.Borders(table.column("text").combine_chunks(), W.separators("pieces"))
        ends = np.zeros(256, bool)
        ends[W.PIECE_ENDS] = True
        self.of_lang = np.asarray(self.lang.indices)[found.text]
        size = found.end - found.start
        self.offset = np.concatenate([[0], np.cumsum(size + 1)])
        self.buffer = np.full(self.offset[-1], 32, np.uint8)
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        self.buffer[np.repeat(self.offset[:-1], size) + within] = found.lowered()[np.repeat(found.start, size) + within]
        # words of one piece have the same number here
        piece = np.cumsum(ends[found.data])[found.start] if len(found.start) else found.start
        self.piece = np.cumsum(np.append(False, (piece[1:] != piece[:-1]) | (found.text[1:] != found.text[:-1]))) if len(piece) else piece
        self.longest = longest
        power = np.full(len(self.buffer) + 1, _BASE, np.uint64)
        power[0] = 1
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[self.buffer] * np.cumprod(power)[:-1], dtype=np.uint64)])
        self._at = prefix[self.offset]
        power[1:] = _INVERSE
        self._back = np.cumprod(power)[self.offset[:-1]]
        names = pa.array(self.lang.dictionary).to_pylist()
        seeds = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names]
        self._seed = np.array(seeds, np.uint64)[self.of_lang] if names else np.zeros(0, np.uint64)

    def runs(self, n: int) -> np.ndarray:
        """First words of the runs of ``n`` words that lie within a piece."""
        count = len(self.piece) - n + 1
        return np.flatnonzero(self.piece[:count] == self.piece[n - 1:]) if count > 0 else np.zeros(0, np.int64)

    def fingerprints(self, n: int, first: np.ndarray) -> np.ndarray:
        value = (self._at[first + n] - self._at[first]) * self._back[first]
        return W.mix(value + self._seed[first] + np.uint64(n))

    def phrases(self, n: int, first: np.ndarray) -> pa.Array:
        return W.strings(self.buffer, self.offset[first], self.offset[first + n] - 1)


def _send(bits: int, longest: int):
    """One block: its fingerprints, by hash range."""

    def run(table: pa.Table) -> pa.Table:
        number = table.column("block")[0].as_py()
        block = _Block(table, longest)
        found = np.sort(np.concatenate([block.fingerprints(n, block.runs(n)) for n in range(1, longest + 1)]))
        key = found >> np.uint64(64 - LOW - bits)
        begins, ends = _edges(key)
        key, count = key[begins], ends - begins
        out = []
        for kind, chosen in ((SINGLE, count == 1), (SHARED, count > 1)):
            low, bucket = _packed(key[chosen]), (key[chosen] >> np.uint64(LOW)).astype(np.int64)
            more = np.minimum(count[chosen], 0xFFFFFFFF).astype(np.uint32)
            for a, b in zip(*_edges(bucket), strict=True):
                payload = low[a:b].tobytes() + (more[a:b].tobytes() if kind == SHARED else b"")
                out.append((int(bucket[a]), kind, payload))
        W.release()
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table({"bucket": pa.array(columns[0], pa.int32()), "block": pa.array([number] * len(out), pa.int64()),
                         "kind": pa.array(columns[1], pa.int32()), "payload": pa.array(columns[2], pa.binary())})

    return run


def _often(least: int):
    """One hash range: the fingerprints found often enough, for each block that holds them."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys, counts, owners, blocks, at = [], [], [], [], 0
        for batch in table.to_batches():
            kind, payload = batch.column("kind").to_numpy(), batch.column("payload")
            blocks.append(batch.column("block").to_numpy())
            for i in range(batch.num_rows):
                part = payload[i].as_buffer()
                n = part.size // (BYTES if kind[i] == SINGLE else BYTES + 4)
                keys.append(_unpacked(np.frombuffer(part, np.uint8, n * BYTES)))
                counts.append(np.ones(n, np.uint32) if kind[i] == SINGLE else np.frombuffer(part, np.uint32, n, n * BYTES))
                owners.append(np.full(n, at, np.int32))
                at += 1
        key, count, owner, block = map(np.concatenate, (keys, counts, owners, blocks))
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        begins, ends = _edges(key)
        total = np.add.reduceat(count[order].astype(np.int64), begins)
        keep = np.repeat(total >= least, ends - begins)
        key, owner = key[keep], owner[keep]
        order = np.argsort(owner, kind="stable")
        key, owner = key[order], owner[order]
        begins, ends = _edges(owner)
        return pa.table({
            "block": pa.array(block[owner[begins]], pa.int64()), "bucket": pa.array([bucket] * len(begins), pa.int32()),
            "payload": pa.array([_packed(key[a:b]).tobytes() for a, b in zip(begins, ends, strict=True)], pa.binary()),
        })

    return run


def _materialise(bits: int, longest: int):
    """One block: exact counts of the phrases whose fingerprint was found often enough; all words as an empty phrase."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])

    def run(texts: pa.Table, often: pa.Table) -> pa.Table:
        block = _Block(texts, longest)
        known = [_unpacked(np.frombuffer(p, np.uint8)).astype(np.uint64) | (np.uint64(b) << np.uint64(LOW)) for b, p in zip(
            often.column("bucket").to_pylist(), often.column("payload").to_pylist(), strict=True)]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        langs = len(block.lang.dictionary)
        out = [pa.record_batch([block.lang.dictionary.cast(pa.string()), pa.array([""] * langs), pa.array([0] * langs, pa.int32()),
                                pa.array(np.bincount(block.of_lang, minlength=langs))], schema=schema)]
        for n in range(1, longest + 1):
            first = block.runs(n)
            key = block.fingerprints(n, first) >> np.uint64(64 - LOW - bits)
            place = np.searchsorted(known, key)
            place[place == len(known)] = 0
            first = first[known[place] == key] if len(known) else first[:0]
            phrase = block.phrases(n, first).dictionary_encode()
            code = np.asarray(phrase.indices, np.int64) * max(langs, 1) + block.of_lang[first]
            code, count = np.unique(code, return_counts=True)
            out.append(pa.record_batch([
                block.lang.dictionary.cast(pa.string()).take(pa.array(code % max(langs, 1))), phrase.dictionary.take(pa.array(code // max(langs, 1))),
                pa.array([n] * len(code), pa.int32()), pa.array(count.astype(np.int64))], schema=schema))
        W.release()
        return pa.Table.from_batches(out)

    return run


def counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``lang, phrase, words, n``: every run of at most ``longest`` words found ``least`` times or more in its language.

    The row with 0 words is the number of all words of the language.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    blocks = stored(texts.filter("text <> ''").mapInArrow(_blocks(block_bytes), _BLOCKS), "phrase-blocks")
    size = blocks.agg(F.sum("size")).first()[0] or 0
    bits = min(MOST_BITS, max(4, (size // range_bytes).bit_length()))
    texts = blocks.select("block", "lang", "text")
    sent = texts.groupBy("block").applyInArrow(_send(bits, longest), _SENT)
    back = sent.groupBy("bucket").applyInArrow(_often(least), _BACK)
    found = texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_materialise(bits, longest), _COUNTED)
    return found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("words") == 0))


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, contained: int = CONTAINED,
         block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to ``longest`` words of each language.

    Words are runs of anything but blanks and tabs within pieces that ``.,;:!?`` and line ends bound, A-Z in lower
    case. ``a`` is how often the phrase occurs (``least`` times or more), ``l`` and ``r`` how often the two sides of
    its weakest cut do, ``score`` is ``floor(SCALE * a / (l + r))`` at that cut, the first one among equals. A phrase that lies in
    a longer one with at least ``contained`` percent of its occurrences is left out. ``n`` counts the words of the
    language. A null lang is ``und``, a null text has no words; rows that repeat count each; other columns are
    ignored; an empty table gives an empty result.
    """
    table = stored(counts(docs, least, longest, block_bytes, range_bytes), "phrase-counts")
    known = table.filter("words > 0").select("lang", "phrase", "n")
    of_lang = table.filter("words = 0").select("lang", F.col("n").alias("all"))
    words = F.split("phrase", " ")
    candidates = table.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), words.alias("w"))

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    part = lambda at, size: F.array_join(F.slice("w", at, size), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    sides = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    sides = sides.join(known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    wide = lambda c: c.cast("decimal(20,0)")
    score = F.call_function("div", wide(F.col("a")) * F.lit(SCALE).cast("decimal(10,0)"), wide(F.col("l") + F.col("r")))
    weakest = sides.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda at: F.array_join(F.slice("w", at, n), " "))))
    inside = candidates.filter("words > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * wide(F.col("longer")) < contained * wide(F.col("a"))))
    best = kept.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    # the best of each share of a language first, so that no task ranks a whole language
    for keys in ([F.col("lang"), F.pmod(F.xxhash64("phrase"), F.lit(SHARES))], [F.col("lang")]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase"))
        best = best.withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.join(of_lang, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("all").alias("n"), "score")
