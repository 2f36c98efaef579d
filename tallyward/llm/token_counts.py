"""Token counts with a whole-token shortcut for a sentencepiece BPE model.

Proved once per model, from the vocabulary alone:

* no piece has a word mark after another character, so no merge ever crosses from the end of one word to the mark of
  the next: a text is the sum of its pre-tokens, each a run of marks with what follows up to the next mark;
* which pieces, written as a pre-token, encode as that one piece and nothing else.

Pre-tokens among the latter count 1 without any merging. Only the others are encoded, each distinct one once per batch.
"""

import functools

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.tables import text_or_empty
from tallyward.llm.words import release

MARK = "▁"
LIMIT = 4096
REMEMBERED = 200_000  # pre-tokens whose counts a worker keeps; more only cost time
_PRE_TOKEN = regex.compile(r" +[^ ]*")


class Counter:
    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {self.model.id_to_piece(i): i for i in range(self.model.get_piece_size())}
        crossing = [p for p in pieces if MARK in p.lstrip(MARK)]
        if crossing or self.model.encode("a", out_type=str)[0][0] != MARK or "".join(self.model.encode("  b ", out_type=str)) != MARK * 3 + "b" + MARK:
            raise ValueError(f"this model's texts are not the sum of their words: {crossing[:3]}")
        ordinary = [(p, i) for p, i in pieces.items() if p[0] == MARK and not self.model.is_control(i)]
        alone = self.model.encode([p[1:].replace(MARK, " ") for p, _ in ordinary], num_threads=1)
        #: what follows the first mark of a pre-token that is one token
        self.whole = {p[1:].replace(MARK, " ") for (p, i), ids in zip(ordinary, alone, strict=True) if ids == [i]}
        # a mark alone, at a text's end: the library adds none to an empty text, so it is measured behind a word
        self.lone = {"": len(self.model.encode("a ")) - len(self.model.encode("a"))}
        self.known: dict[str, int] = dict(self.lone)

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens without their first mark."""
        if not text:
            return []
        text = text.replace(MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [p[1:] for p in _PRE_TOKEN.findall(" " + text)]
        return text.split(" ")

    def count(self, texts: list[str]) -> list[int]:
        whole, known = self.whole, self.known
        if len(known) > REMEMBERED:
            known.clear()
            known.update(self.lone)
        own = [self.pre_tokens(t) for t in texts]
        rest = [[p for p in parts if p not in whole] for parts in own]
        new = list({p for parts in rest for p in parts}.difference(known))
        for at in range(0, len(new), 10_000):
            part = new[at: at + 10_000]
            known.update(zip(part, map(len, self.model.encode(part, num_threads=1)), strict=True))
        return [len(a) - len(b) + sum([known[p] for p in b]) for a, b in zip(own, rest, strict=True)]


@functools.lru_cache(4)
def counter(path: str) -> Counter:
    """One counter per worker process."""
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row: whole texts, a null text as an empty one (0 tokens).

    Equal to encoding with the library's defaults, without begin or end tokens; strings that look like special tokens
    are ordinary text. Repeated rows count alike; other columns are ignored. No shuffle.
    """

    def run(batches):
        c = counter(path)
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 200):
                out += c.count(batch.column("text").slice(at, 200).to_pylist())
            n = pa.array(out, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), n], names=["doc_id", "n_bytes", "n_tokens"])
        release()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    counted = texts.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
