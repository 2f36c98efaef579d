"""N-gram Jaccard self-join: rare-first prefix filtering with length, positional and suffix filters.

1. Every task turns its texts into sets of hashed shingles and sorts them; hashes leave the task in
   blocks of one hash range each, a hash that several texts of the block share as one entry with a count.
2. Each hash range counts its hashes. Only hashes found in two texts or more go back to the block they
   came from: a hash of one text can't link anything, and as the rarest come first in the global order,
   such hashes only take up room in the prefix. A text whose prefix holds nothing else is done.
3. Equal sets become one node. Nodes that share a prefix hash are compared in rounds: first with one
   centre per hash, then only nodes that have another label than most of the hash's nodes:
   pair by pair where few nodes share the hash, in blocks of nodes where many do. Equal labels mean one component, so
   no link between different components is lost: a pair is left out only when both nodes are in
   one component already, or when a filter proves that it can't link. No round emits all pairs of a group.
4. A pair is verified on whole sets, once in a round; the components of all links are found once, at the end.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm import words as W
from tallyward.llm.stars import components
from tallyward.llm.tables import fresh, partitions, stored, text_or_empty

SIZE, NUM, DEN = 5, 75, 100
BLOCK_BYTES = 2 << 20  # of text, or more where there are many hash ranges; a block's arrays take about 30 times as much
LOW = np.uint64((1 << 40) - 1)
HOT = 128  # a token of more nodes is compared block by block
BLOCK = 512  # nodes
SMALL = 100_000  # so many labels, of 16 bytes, may be broadcast
SALTS = 16  # shares of the rows of one label
HEAD, SINGLE, SHARED, HELD = 0, 1, 2, 3

_BLOCK = "bucket int, block long, kind int, n int, payload binary"
_COUNTED = "block long, kind int, n int, payload binary"
_SETS = "doc_id long, n long, k1 long, k2 long, tokens array<long>"


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join(a.tobytes() for a in arrays)


def _split(payload: bytes, n: int, *types) -> list[np.ndarray]:
    out, at = [], 0
    for t in types:
        out.append(np.frombuffer(payload, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def _runs(values: np.ndarray):
    """Begin and end of each run of equal values."""
    if len(values):
        begins = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        yield from zip(begins, np.append(begins[1:], len(values)), strict=True)


def _batch(schema: pa.Schema, columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _blocks(bits: int, size: int, most_bytes: int):
    flags = W.separators("blank")
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("payload", pa.binary())])

    def run(batches):
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in W.slices(batch, "text", most_bytes):
                at += 1
                yield _batch(schema, list(zip(*_block(part, at), strict=True)))
        W.release()

    def _block(part: pa.RecordBatch, block: int) -> list[tuple]:
        rows = part.num_rows
        text, h = W.shingles(W.Words(part.column("text"), flags), size)
        order = np.argsort(h, kind="stable")
        text, h = text[order].astype(np.uint16), h[order]
        if len(h):  # one text's repeats are neighbours, as texts ascend within a hash
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
            text, h = text[new], h[new]
        n = np.bincount(text, minlength=rows).astype(np.int64)
        by_text = np.argsort(text, kind="stable")
        keys = []
        for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
            sums = np.concatenate([[0], np.cumsum(W.mix(h[by_text] ^ np.uint64(salt)), dtype=np.uint64)]).astype(np.uint64)
            ends = np.cumsum(n)
            keys.append(sums[ends] - sums[ends - n])
        ids = part.column("doc_id")
        known = np.asarray(ids.is_valid())
        head = _pack(np.asarray(ids.fill_null(0), np.int64), known.astype(np.uint8), n, *keys)
        spread = (block * 0x9E3779B1 >> 7) % (1 << bits)
        out = [(spread, block, HEAD, rows, head)]
        if not len(h):
            return out
        edge = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        count = np.diff(np.append(edge, len(h)))
        one = np.zeros(len(h), bool)
        one[edge[count == 1]] = True
        if not one.all():
            out.append((spread, block, HELD, int((~one).sum()), _pack(h[~one], text[~one])))
        for kind, hash_, more in ((SINGLE, h[one], text[one]), (SHARED, h[edge[count > 1]], count[count > 1].astype(np.uint32))):
            bucket = (hash_ >> np.uint64(64 - bits)).astype(np.int64)
            low = hash_ & LOW
            low32, low8 = low.astype(np.uint32), (low >> np.uint64(32)).astype(np.uint8)
            for a, b in _runs(bucket):
                out.append((int(bucket[a]), block, kind, int(b - a), _pack(low32[a:b], low8[a:b], more[a:b])))
        return out

    return run


def _count(table: pa.Table) -> pa.Table:
    """One hash range: how many texts have each hash; what is found twice goes back to its block."""
    bucket = table.column("bucket")[0].as_py()
    out, hashes, counts, owner, texts, kinds = [], [], [], [], [], []
    blocks = []
    for block, kind, n, payload in zip(*(table.column(c).to_pylist() for c in ("block", "kind", "n", "payload")), strict=True):
        if kind in (HEAD, HELD):
            out.append((block, kind, n, payload))
            continue
        a, b, more = _split(payload, n, np.uint32, np.uint8, np.uint16 if kind == SINGLE else np.uint32)
        hashes.append(a.astype(np.uint64) | (b.astype(np.uint64) << np.uint64(32)))
        counts.append(np.ones(n, np.int64) if kind == SINGLE else more.astype(np.int64))
        texts.append(more if kind == SINGLE else np.zeros(n, np.uint16))
        owner.append(np.full(n, len(blocks)))
        blocks.append((block, kind))
    if blocks:
        h, c, o, t = map(np.concatenate, (hashes, counts, owner, texts))
        order = np.argsort(h, kind="stable")
        h, c, o, t = h[order], c[order], o[order], t[order]
        edge = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        total = np.add.reduceat(c, edge)
        df = np.repeat(total, np.diff(np.append(edge, len(h))))
        keep = df > 1
        h, o, t, df = h[keep] | np.uint64((bucket & 0xFFFF) << 40), o[keep], t[keep], df[keep]
        order = np.argsort(o, kind="stable")
        h, o, t, df = h[order], o[order], t[order], df[order]
        for a, b in _runs(o):
            block, kind = blocks[o[a]]
            level = np.minimum(np.floor(4 * np.log2(df[a:b])), 127).astype(np.uint8)
            out.append((block, kind, int(b - a), _pack(h[a:b], level, t[a:b]) if kind == SINGLE else _pack(h[a:b], level)))
    schema = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("payload", pa.binary())])
    columns = list(zip(*out, strict=True)) or [[]] * 4
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _rebuild(bits: int, num: int, den: int):
    """One block: the texts that may have a partner get their found-twice hashes, rarest first."""

    def identity(h: np.ndarray) -> np.ndarray:
        """What the count keeps of a full hash: its range number and its low 40 bits."""
        return (h & LOW) | (((h >> np.uint64(64 - bits)) & np.uint64(0xFFFF)) << np.uint64(40))

    def run(table: pa.Table) -> pa.Table:
        parts = {HEAD: [], SINGLE: [], SHARED: [], HELD: []}
        for kind, n, payload in zip(*(table.column(c).to_pylist() for c in ("kind", "n", "payload")), strict=True):
            types = {HEAD: (np.int64, np.uint8, np.int64, np.uint64, np.uint64), SINGLE: (np.uint64, np.uint8, np.uint16),
                     SHARED: (np.uint64, np.uint8), HELD: (np.uint64, np.uint16)}[kind]
            parts[kind].append(_split(payload, n, *types))
        ids, known, n, k1, k2 = parts[HEAD][0]
        h, level, t = [], [], []
        for a, b, c in parts[SINGLE]:
            h.append(a), level.append(b), t.append(c)
        if parts[HELD]:
            sh, sd = map(np.concatenate, zip(*parts[SHARED], strict=True))
            order = np.argsort(sh)
            sh, sd = sh[order], sd[order]
            for a, c in parts[HELD]:
                a = identity(a)
                h.append(a), level.append(sd[np.searchsorted(sh, a)]), t.append(c)
        arrays = [None] * len(ids)
        if h:
            h, level, t = map(np.concatenate, (h, level, t))
            token = ((level.astype(np.uint64) << np.uint64(56)) | h).astype(np.int64)
            found = np.bincount(t, minlength=len(ids))
            order = np.lexsort((token, t))
            token, ends = token[order], np.cumsum(found)
            for i in np.flatnonzero((n > 0) & (den * found >= num * n)):
                arrays[i] = token[ends[i] - found[i]: ends[i]]
        return pa.table([
            pa.array(ids, mask=known == 0), pa.array(n), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
            pa.array(arrays, pa.list_(pa.int64())),
        ], names=["doc_id", "n", "k1", "k2", "tokens"])

    return run


def sets(docs: DataFrame, size: int = SIZE, num: int = NUM, den: int = DEN) -> DataFrame:
    """A row per document: ``doc_id, n`` (shingles), ``k1, k2`` (the set's key) and ``tokens``.

    ``tokens`` holds, rarest first, the shingles that other texts have as well, and is null where too few
    are: then no other text can reach the threshold. A token is 7 bits for the logarithm of the number of
    texts that hold it, then up to 56 bits of its hash: 40 and the number of its hash range.
    """
    bits = min(16, max(8, (8 * partitions(docs.sparkSession) - 1).bit_length()))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    blocks = texts.mapInArrow(_blocks(bits, size, max(BLOCK_BYTES, 128 << bits)), _BLOCK)
    counted = blocks.groupBy("bucket").applyInArrow(_count, _COUNTED)
    return counted.groupBy("block").applyInArrow(_rebuild(bits, num, den), _SETS)


def _bound(x: np.ndarray, y: np.ndarray, depth: int) -> int:
    """Suffix filter: no more common tokens than this; cuts both arrays at the middle of one."""
    if not depth or len(x) < 8 or len(y) < 8:
        return min(len(x), len(y))
    m = len(y) // 2
    i = int(np.searchsorted(x, y[m]))
    hit = int(i < len(x) and x[i] == y[m])
    return _bound(x[:i], y[:m], depth - 1) + hit + _bound(x[i + hit:], y[m + 1:], depth - 1)


def _verify(num: int, den: int):
    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            ta, tb = batch.column("ta"), batch.column("tb")
            for i in range(batch.num_rows):
                x, y = ta[i].values.to_numpy(), tb[i].values.to_numpy()
                need = -(-num * int(na[i] + nb[i]) // (num + den))
                if _bound(x, y, 3) >= need:
                    keep[i] = len(np.intersect1d(x, y, assume_unique=True)) >= need
            yield batch.select(["a", "b", "la", "lb"]).filter(pa.array(keep))

    return run


def _linked(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that link, with the labels they came with."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "la", "lb", "na", "nb", "ta", "tb").mapInArrow(
        _verify(num, den), "a long, b long, la long, lb long"
    )


def _candidates(met: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs, each once, of rows that hold two prefix rows of one token, ``l`` and ``r``."""
    need = F.expr(f"{num} * (l.n + r.n)")
    room = F.expr(f"{num + den} * least(l.n - l.i, r.n - r.i)")  # holds at the pair's first common token
    turned = F.expr("l.node > r.node")
    return (
        met.filter("l.label <> r.label")
        .filter(F.expr(f"{den} * least(l.n, r.n) >= {num} * greatest(l.n, r.n)"))
        .filter(room >= need)
        .select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b"),
                F.when(turned, F.col("r.label")).otherwise(F.col("l.label")).alias("la"),
                F.when(turned, F.col("l.label")).otherwise(F.col("r.label")).alias("lb"))
        .distinct()
    )


def _prefix(nodes: DataFrame, num: int, den: int) -> DataFrame:
    """``token, node, n, i``: the prefix of every node; ``i`` is the place in the whole set, rarest first."""
    return (
        nodes.withColumn("alone", F.col("n") - F.size("tokens"))
        .withColumn("length", F.expr(f"n - cast(ceil({num} * n / {den}) as long) + 1 - alone").cast("int"))
        .select("node", "n", "alone", F.posexplode(F.slice("tokens", 1, F.col("length"))))
        .select(F.col("col").alias("token"), "node", "n", (F.col("alone") + F.col("pos")).alias("i"))
    )


_ROW = ("node", "n", "i", "label")


def _met(rows: DataFrame, turn: int) -> DataFrame:
    """The prefix rows of tokens whose nodes have different labels as ``token, l``, each with a centre of its token as ``r``.

    The centre is the smallest node in the first turn and one by hash in the others.
    """
    order = F.col("node") if turn == 0 else F.xxhash64("node", F.lit(turn))
    centres = rows.groupBy("token").agg(
        F.min(F.struct(order.alias("h"), *_ROW)).alias("c"), F.min("label").alias("low"), F.max("label").alias("high"),
    ).filter("low <> high").select("token", F.struct(*[f"c.{c}" for c in _ROW]).alias("r"))
    return rows.select("token", F.struct(*_ROW).alias("l")).join(centres, "token")


def _relabelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after new links: each label goes over to the smallest one it is linked to, and on to where that goes.

    Nodes of one label are in one component; nodes of one component may still have different labels, which costs
    comparisons, but no link.
    """
    ends = links.select(F.col("la").alias("label"), F.col("lb").alias("to"))
    ends = ends.unionByName(ends.select(F.col("to").alias("label"), F.col("label").alias("to")))
    over = ends.groupBy("label").agg(F.min("to").alias("to")).filter("to < label")
    on = over.select(F.col("label").alias("to"), F.col("to").alias("on"))
    over = stored(over.join(on, "to", "left").select("label", F.coalesce("on", "to").alias("to")), "ngram-labels")
    if over.count() <= SMALL:
        return rows.join(F.broadcast(over), "label", "left").withColumn("label", F.coalesce("to", "label")).drop("to")
    # many rows may have one label: they are dealt out by a salt, for which the table of labels comes several times
    over = over.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    return salted.join(over, ["label", "salt"], "left").withColumn("label", F.coalesce("to", "label")).drop("to", "salt")


def _compare(num: int, den: int):
    """Two blocks of nodes: common tokens of all pairs by matrix products over slices of the tokens."""

    def matrix(node: np.ndarray, column: np.ndarray, rows: int, lo: int, hi: int) -> np.ndarray:
        out = np.zeros((rows, hi - lo), np.float32)
        here = (column >= lo) & (column < hi)
        out[node[here], column[here] - lo] = 1
        return out

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        node, label, n = (table.column(c).to_numpy() for c in ("node", "label", "n"))
        tokens = table.column("tokens").combine_chunks()
        length = np.diff(tokens.offsets.to_numpy())
        owner, token = np.repeat(np.arange(len(node)), length), tokens.flatten().to_numpy()
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        place = {x: np.zeros(len(node), np.int64) for x in (0, 1)}
        place[0][left], place[1][right] = np.arange(len(left)), np.arange(len(right))
        in_left, in_right = (side != 1)[owner], (side != 0)[owner]
        both = np.intersect1d(token[in_left], token[in_right])
        common = np.zeros((len(left), len(right)), np.float32)
        column = np.searchsorted(both, token)
        column[column == len(both)] = 0
        known = both[column] == token if len(both) else np.zeros(len(token), bool)
        l, r = in_left & known, in_right & known  # noqa: E741
        for lo in range(0, len(both), 4096):
            hi = min(lo + 4096, len(both))
            common += matrix(place[0][owner[l]], column[l], len(left), lo, hi) @ matrix(place[1][owner[r]], column[r], len(right), lo, hi).T
        total = n[left][:, None] + n[right][None, :]
        i, j = np.nonzero(((num + den) * common.astype(np.int64) >= num * total) & (label[left][:, None] != label[right][None, :]))
        # one link of a node to each other component is enough
        _, one = np.unique(np.stack([left[i], label[right[j]]]), axis=1, return_index=True)
        return pa.table([pa.array(node[left[i[one]]], pa.int64()), pa.array(node[right[j[one]]], pa.int64())], names=["a", "b"])

    return run


def _hot_links(rows: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """Links among the nodes of tokens that many nodes share.

    Such nodes form groups (joined by these tokens), which are cut by length: a node can only link with nodes of its own
    length class and the two beside it. Of two such classes, the nodes outside the group's largest label are compared with all
    nodes, block by block; a pair of blocks is one task's work, so a group of any size is spread out.
    """
    low = rows.groupBy("token").agg(F.min("node").alias("low"))
    group = components(rows.join(low, "token").select("node", "low"), "node", "low").withColumnRenamed("root", "group")
    step = max(float(np.log(den / num)), 1e-9) * (1 + 1e-9)  # a hair more, so that rounding can't part two that link
    length = F.floor(F.ln("n") / F.lit(step)).cast("int")
    known = rows.select("node", "label", length.alias("class")).distinct()
    members = group.join(known, "node")
    sizes = members.groupBy("group", "label").agg(F.count("*").alias("size"))
    shape = sizes.groupBy("group").agg(F.max_by("label", F.struct("size", "label")).alias("major"))
    # a node meets its own class, and as the longer one the class below; both as a pair of classes "of"
    members = members.join(shape, "group").withColumn("rest", F.col("label") != F.col("major"))
    members = members.withColumn("of", F.explode(F.array("class", F.col("class") + 1)))
    counted = members.groupBy("group", "of").agg(F.count_if("rest").alias("rests"), F.count_if(~F.col("rest")).alias("others"))

    def blocks(count):
        return F.greatest(F.lit(1), F.ceil(count / F.lit(BLOCK))).cast("int")

    members = (
        members.join(counted.filter("rests > 0"), ["group", "of"])
        .withColumn("blocks", blocks(F.col("rests")) + blocks(F.col("others")))
        .withColumn("rests", blocks(F.col("rests")))
        .withColumn("block", F.when(F.col("rest"), F.pmod(F.xxhash64("node"), F.col("rests"))).otherwise(
            F.col("rests") + F.pmod(F.xxhash64("node"), F.col("blocks") - F.col("rests"))).cast("int"))
    )
    # a pair (x, y) of blocks has x <= y and x < rests
    as_left = F.when(F.col("block") < F.col("rests"), F.transform(F.sequence("block", F.col("blocks") - 1), lambda y: F.struct(
        F.col("block").alias("x"), y.alias("y"), F.when(y == F.col("block"), 2).otherwise(0).alias("side")))).otherwise(F.array())
    lower = F.least(F.col("block"), F.col("rests")) - 1
    as_right = F.when(lower >= 0, F.transform(F.sequence(F.lit(0), F.greatest(lower, F.lit(0))), lambda x: F.struct(
        x.alias("x"), F.col("block").alias("y"), F.lit(1).alias("side")))).otherwise(F.array())
    dealt = members.withColumn("at", F.explode(F.concat(as_left, as_right))).select("group", "of", "at.*", "node", "label")
    return (
        dealt.join(nodes.select("node", "n", "tokens"), "node")
        .groupBy("group", "of", "x", "y").applyInArrow(_compare(num, den), "a long, b long")
    )


def link(docs: DataFrame, size: int = SIZE, num: int = NUM, den: int = DEN, rounds: int = 2) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (columns ``doc_id, text``).

    Words are runs of anything but ASCII white space, A-Z in lower case; a set holds the distinct shingles of
    ``size`` words, of a text with fewer words the whole text as one. Rows link when
    ``den * intersection >= num * union``. ``component_id`` is the smallest ``doc_id`` of the component. A null,
    empty or blank text has an empty set and links with nothing. Rows that repeat are rows of one node; a null
    ``doc_id`` takes part but names no component unless all its rows have none. Shingles are compared by
    48 to 56 bits of their hash. Other columns are ignored; an empty table gives an empty result.
    """
    table = stored(sets(docs, size, num, den), "ngram-sets")
    nodes = stored(
        table.filter("tokens IS NOT NULL").groupBy("k1", "k2", "n")
        .agg(F.min("doc_id").alias("doc_id"), F.any_value("tokens").alias("tokens"))
        .withColumn("node", F.col("k1")), "ngram-nodes",
    )
    rows = _prefix(nodes, num, den).withColumn("label", F.col("node"))
    links = []
    for turn in range(rounds):
        met = stored(_met(rows, turn), "ngram-prefixes")
        links.append(stored(_linked(_candidates(met, num, den), nodes, num, den), "ngram-links"))
        rows = _relabelled(met.select("token", "l.*"), links[-1])
    left = rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("rows"))
    left = left.filter("low <> high").select("token", (F.col("rows") > HOT).alias("hot"))
    rows = stored(rows.join(left, "token"), "ngram-prefixes")
    cold, hot = rows.filter("NOT hot"), rows.filter("hot")
    if not cold.isEmpty():
        counted = cold.groupBy("token", "label").agg(F.count("*").alias("rows"))
        major = counted.groupBy("token").agg(F.max_by("label", F.struct("rows", "label")).alias("major"))
        rest = cold.join(major, "token").filter("label <> major").select("token", F.struct(*_ROW).alias("l"))
        met = rest.join(cold.select("token", F.struct(*_ROW).alias("r")), "token")
        links.append(_linked(_candidates(met, num, den), nodes, num, den))
    if not hot.isEmpty():
        links.append(_hot_links(hot, nodes, num, den))
    found = links[0].select("a", "b")
    for more in links[1:]:
        found = found.unionByName(more.select("a", "b"))
    # written first: verifying and joining stars in one task would need two Python workers at once
    labels = components(stored(found, "ngram-links"), "a", "b")
    placed = nodes.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_set = placed.select("k1", "k2", "n", "root").join(named, "root").drop("root")
    alone = table.filter("tokens IS NULL").withColumn("component_id", F.col("doc_id"))
    linked = table.filter("tokens IS NOT NULL").join(of_set, ["k1", "k2", "n"], "left")
    return linked.unionByName(alone, allowMissingColumns=True).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, size: int = SIZE, num: int = NUM, den: int = DEN) -> DataFrame:
    """The rows of ``docs``, all columns kept, with one row left of each group of linked texts: that of its smallest id.

    Texts with no words stay. An id names one text: of rows alike in id and text one stays, rows without an id stay.
    """
    groups = link(docs, size, num, den)
    kept = groups.filter("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    digest, at = fresh(docs, "_digest"), fresh(docs, "_at")
    rows = docs.join(kept, F.col("doc_id").cast("long") == F.col("_kept"), "left_semi")
    rows = rows.withColumn(digest, F.xxhash64(text_or_empty(), F.col("text").isNull()))
    rows = rows.withColumn(at, F.row_number().over(Window.partitionBy("doc_id", digest).orderBy(F.lit(0)))).filter(F.col(at) == 1)
    return rows.drop(digest, at).unionByName(docs.filter("doc_id IS NULL"))
