"""Source divergence audit: how far the sources of a language differ in their use of terms.

1. Every task takes slices of its texts. The bytes of a slice stay in one buffer; a pointer marks the start of each
   term in it. Pointers are dealt to one slice per (lang, source) and ordered by multikey quicksort, with eight bytes
   as one character: equal runs go on with the next eight bytes, so no term is ever made into an object. A run of
   equal terms gives the count and, as its pointers still go by text, the document frequency.
2. The runs are added up by (lang, source, term), then document frequencies by (lang, term), and the terms of enough
   documents are written once.
3. Probabilities are whole numbers. Pairs of sources are compared in blocks of sources and terms: a task holds one
   dense block, whatever a language has of either.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm import words as W
from tallyward.llm.tables import stored

LEAST_DOCS = 30
TOP = 50
SCALE, PRIOR = 1_000_000_000, 5
SLICE_BYTES = 8 << 20
TERMS, SOURCES = 4096, 256  # of one block

_COUNTS = "lang string, source string, term string, n long, docs long"
_MASK = np.array([(1 << 64) - (1 << (64 - 8 * r)) for r in range(9)], np.uint64)


def pointer_sort(data: np.ndarray, start: np.ndarray, end: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointers in the order of (part, term), stable, and which of them begin a run of equal ones.

    Terms hold no zero byte, so a term that ends is a character of zeros.
    """
    window = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    size = end - start
    order, new = np.arange(len(start)), np.zeros(len(start), bool)
    at, run, depth = np.arange(len(start)), part, 0
    while len(at):
        pointer = order[at]
        begin = np.minimum(start[pointer] + depth, len(data))
        key = window[begin].view(">u8").ravel().astype(np.uint64) & _MASK[np.clip(size[pointer] - depth, 0, 8)]
        by = np.lexsort((key, run))
        order[at], key, run = pointer[by], key[by], run[by]
        new[at[0]] = True
        new[at[1:]] |= (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        edges = np.flatnonzero(new[at])
        length = np.diff(np.append(edges, len(at)))
        depth += 8
        going_on = (length > 1) & (np.maximum.reduceat(size[order[at]], edges) > depth)
        run = np.repeat(np.arange(len(edges)), length)
        keep = np.repeat(going_on, length)
        at, run = at[keep], run[keep]
    return order, new


def _runs(flags: np.ndarray, most_bytes: int):
    """Counts of the terms of each (lang, source) in each slice; an empty term stands for the group itself."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text", most_bytes):
                yield counted(part)
        W.release()

    def counted(part: pa.RecordBatch) -> pa.RecordBatch:
        lang, source = (part.column(c).dictionary_encode() for c in ("lang", "source"))
        code = np.asarray(lang.indices, np.int64) * max(len(source.dictionary), 1) + np.asarray(source.indices, np.int64)
        groups, group = np.unique(code, return_inverse=True)
        found = W.Borders(part.column("text"), flags)
        data = found.lowered()
        order, new = pointer_sort(data, found.start, found.end, group[found.text])
        edges = np.flatnonzero(new)
        text = found.text[order]
        new_text = new.copy()
        new_text[1:] |= text[1:] != text[:-1]
        docs = np.add.reduceat(new_text.astype(np.int64), edges) if len(edges) else edges
        first = order[edges]
        none = np.zeros(len(groups), np.int64)
        of = np.concatenate([group[found.text[first]], np.arange(len(groups))])
        term = pa.concat_arrays([W.strings(data, found.start[first], found.end[first]), pa.array([""] * len(groups), pa.string())])
        return pa.RecordBatch.from_arrays([
            lang.dictionary.take(pa.array(groups // max(len(source.dictionary), 1))).take(pa.array(of)),
            source.dictionary.take(pa.array(groups % max(len(source.dictionary), 1))).take(pa.array(of)), term,
            pa.array(np.concatenate([np.diff(np.append(edges, len(order))), none])), pa.array(np.concatenate([docs, none])),
        ], schema=schema)

    return run


def _differences(table: pa.Table) -> pa.Table:
    """One block: sums of differences of all pairs of its sources over its terms.

    Terms that no source of the block has count by their number: they are all alike. Rows without a term tell a
    source's value for terms it doesn't have, and how many terms are to be counted here.
    """
    table = table.combine_chunks()
    lang, x, y = (table.column(c)[0].as_py() for c in ("lang", "x", "y"))
    block, p, terms = (table.column(c).to_numpy() for c in ("block", "p", "terms"))
    source, term = (table.column(c).combine_chunks().dictionary_encode() for c in ("source", "term"))
    whose, names = np.asarray(source.indices), source.dictionary
    mark = ~np.asarray(table.column("term").combine_chunks().is_valid())
    absent, side = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    absent[whose[mark]], side[whose[mark]] = p[mark], block[mark]
    value = np.repeat(absent[:, None], len(term.dictionary), axis=1)
    value[whose[~mark], np.asarray(term.indices.fill_null(0))[~mark]] = p[~mark]
    others = terms[mark].max(initial=0) - len(term.dictionary)
    a, b, f = [], [], []
    right = np.flatnonzero(side == y)
    for i in np.flatnonzero(side == x):
        with_ = right[right > i] if x == y else right
        a.append(np.full(len(with_), i))
        b.append(with_)
        f.append(np.abs(value[with_] - value[i]).sum(axis=1) + others * np.abs(absent[with_] - absent[i]))
    a, b, f = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b, f))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": names.take(pa.array(a)), "b": names.take(pa.array(b)),
                     "f": pa.array(f.astype(np.int64))})


def _share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms))`` in whole numbers of any size; 0 without terms."""
    wide = (n + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = (total + PRIOR * terms).cast("decimal(20,0)")
    return F.when(terms > 0, F.call_function("div", wide, whole) + 1).otherwise(0).cast("long")


def counts(docs: DataFrame, least_docs: int = LEAST_DOCS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``lang, source, term, n`` of the terms in at least ``least_docs`` texts of their language.

    Every (lang, source) has a row with an empty term and 0, also when it has no term.
    """
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    runs = texts.mapInArrow(_runs(W.separators("letters"), slice_bytes), _COUNTS)
    added = runs.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    in_lang = F.sum("docs").over(Window.partitionBy("lang", "term"))
    known = added.withColumn("in_lang", in_lang).filter((F.col("in_lang") >= least_docs) | (F.col("term") == ""))
    return known.select("lang", "source", "term", "n")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, terms: int = TERMS, sources: int = SOURCES,
          slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source is from the others, and by which terms.

    Part ``pair``: ``item`` is each other source of the language, ``value`` the sum of differences of their term
    probabilities (in billionths) over all terms kept. Part ``term``: the ``top`` terms that the source uses more than
    its language does, by the excess. Ranks go by value, then by item in byte order. A null text, lang or source counts
    as an empty one; other columns are ignored; rows that repeat count each. A language without terms has pairs of
    value 0; an empty table gives an empty result.
    """
    known = stored(counts(docs, least_docs, slice_bytes), "divergence-counts")
    of_term = known.filter("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("in_lang"))
    of_group = known.groupBy("lang", "source").agg(F.sum("n").alias("in_source"))
    shape = of_group.groupBy("lang").agg(F.count("*").alias("groups")).join(
        of_term.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("in_lang").alias("total")), "lang", "left"
    ).select("lang", "groups", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("total", F.lit(0)).alias("total"))
    blocks = lambda c, size: F.greatest(F.lit(1), F.ceil(F.col(c) / F.lit(size))).cast("int")
    group = stored(of_group.join(shape, "lang").withColumns({
        "term_blocks": blocks("terms", terms), "source_blocks": blocks("groups", sources),
        "absent": _share(F.lit(0).cast("long"), F.col("in_source"), F.col("terms")),
    }).withColumn("block", F.pmod(F.xxhash64("source"), F.col("source_blocks")).cast("int")), "divergence-groups")
    rows = known.filter("term <> ''").join(group, ["lang", "source"]).withColumn(
        "p", _share(F.col("n"), F.col("in_source"), F.col("terms")))

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    excess = F.col("p") - _share(F.col("in_lang"), F.col("total"), F.col("terms"))
    found = rows.join(of_term, ["lang", "term"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess.alias("value"))
    found = found.filter("value > 0").withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)

    here = F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int")
    entries = rows.select("lang", here.alias("at"), "block", "source_blocks", "source", "term", "p", F.lit(0).cast("long").alias("terms"))
    marks = group.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1))).select(
        "lang", "at", "block", "source_blocks", "source", F.lit(None).cast("string").alias("term"), F.col("absent").alias("p"),
        F.when(F.col("at") == 0, F.col("terms")).otherwise(0).cast("long").alias("terms"))
    other = F.explode(F.sequence(F.lit(0), F.col("source_blocks") - 1))
    dealt = entries.unionByName(marks).withColumn("other", other).withColumns(
        {"x": F.least("block", "other"), "y": F.greatest("block", "other")}).drop("other", "source_blocks")
    sums = dealt.groupBy("lang", "at", "x", "y").applyInArrow(_differences, "lang string, a string, b string, f long")
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = (
        sums.groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("f").alias("value")).select("lang", both.alias("s"), "value")
        .select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value").withColumn("rank", F.row_number().over(by_value))
    )
    return pairs.unionByName(found)
