"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs of a word are a vector of the word itself and the mean of the vectors of its character n-grams; words and
n-grams without a vector of their own share one. A text is scored in overlapping windows of words, all of them, and
takes the score of its worst window. Training sees labels of whole texts only, so the first pass tells which windows
of a toxic text to learn from by how strongly their words go with the label.
"""

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm import words as W
from tallyward.llm.tables import ddl, fresh, text_or_empty, without

WINDOW, STRIDE = 32, 24
HIDDEN, DIM = 8, 4
ENTRIES = 4096  # words, and n-grams, with a vector of their own
GRAMS = (4, 5)  # bytes, with a mark at either end of the word
#: The training sample: so many labelled rows, the first by a hash of their id, of texts up to so many characters.
SAMPLE_ROWS, SAMPLE_CHARS = 6000, 20_000
SAMPLE_WINDOWS, EPOCHS, BATCH, RATE = 16_000, 4, 256, 0.02
LEAST_STEPS = 240  # few windows are gone through more often
FOLDS = 5
_FLAGS = W.separators("punct")
_PIECE = 2 << 20


def _grams(words: W.Words, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, hash) of the n-grams of the words that begin at ``first``; whole words, whatever their length."""
    size = words.end[first] - words.start[first]
    owner, found = [], []
    lo, width = 0, 24
    while lo < (size.max() if len(size) else 0):
        some = np.flatnonzero((size > lo) & (size <= width))
        if len(some):
            at = words.start[first[some]][:, None] + np.arange(-1, width + 1)[None, :]
            letter = words.data[np.clip(at, 0, len(words.data) - 1)].astype(np.uint64)
            letter[(letter >= 65) & (letter <= 90)] += 32
            place = np.arange(width + 2)[None, :]
            letter[:, 0] = 1
            letter[place == size[some][:, None] + 1] = 2
            for n in GRAMS:
                h = np.full((len(some), width + 3 - n), n, np.uint64)
                for j in range(n):
                    h = h * np.uint64(0x9E3779B97F4A7C15) + letter[:, j: width + 3 - n + j]
                inside = np.arange(width + 3 - n)[None, :] + n <= size[some][:, None] + 2
                owner.append(np.broadcast_to(some[:, None], h.shape)[inside])
                found.append(W.mix(h[inside]))
        lo, width = width, width * 4
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owner), np.concatenate(found)


def _lookup(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """1 + place in ``known`` (sorted), 0 if it isn't there."""
    out = np.zeros(len(hashes), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        hit = known[at] == hashes
        out[hit] = at[hit] + 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def windows(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, first word) of every window: the last one reaches the text's end, a text without words has one."""
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return text, k * STRIDE


@dataclass
class Network:
    """The parameters; ``words`` and ``grams`` are the sorted hashes that rows 1.. of the tables belong to."""

    words: np.ndarray
    grams: np.ndarray
    p: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None  # the score when there was nothing to learn from

    def inputs(self, words: W.Words) -> tuple[np.ndarray, dict]:
        """Vectors of the distinct words, and which one each word is."""
        _, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        word = _lookup(words.hash[first], self.words)
        # most n-grams have no vector: a table of 16 bits of the hash rules them out
        maybe = np.zeros(1 << 16, bool)
        maybe[(self.grams & np.uint64(0xFFFF)).astype(np.int64)] = True
        parts = []
        for at in range(0, len(first), 20_000):
            owner, hashes = _grams(words, first[at: at + 20_000])
            some = maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
            gram = _lookup(hashes[some], self.grams)
            known = gram > 0
            parts.append((at + owner[some][known], gram[known]))
        owner, gram = (np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts, strict=True) if parts else ((), ())))
        order = np.argsort(owner, kind="stable")
        owner, gram = owner[order], gram[order]
        count = np.bincount(owner, minlength=len(first)).astype(np.float32)
        # a word's n-grams: the mean of those with a vector, else the common one
        weight = 1 / np.maximum(count, 1)
        of_grams = np.empty((len(first), DIM), np.float32)
        for d in range(DIM):
            of_grams[:, d] = np.bincount(owner, self.p["G"][gram, d], len(first)) * weight
        of_grams[count == 0] = self.p["G"][0]
        x = np.concatenate([self.p["E"][word], of_grams], axis=1)
        return x, {"which": which, "word": word, "owner": owner, "gram": gram, "weight": weight, "count": count}

    def run(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; ``at`` (windows x words) are rows of ``x``."""
        p, states, trace = self.p, [], []
        m = mask.astype(np.float32)[:, :, None]
        for side in "fb":
            gates = x @ p["W" + side] + p["b" + side]
            h = np.zeros((len(at), HIDDEN), np.float32)
            out = np.empty((len(at), WINDOW, HIDDEN), np.float32)
            steps = range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1)
            for t in steps:
                g, u = gates[at[:, t]], h @ p["U" + side]
                zr = _sigmoid(g[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                new = np.tanh(g[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
                if keep:
                    trace.append((side, t, h, z, r, new, u[:, 2 * HIDDEN:]))
                h = h + m[:, t] * (1 - z) * (new - h)
                out[:, t] = h
            states.append(out)
        h = np.concatenate(states, axis=2)
        key = np.tanh(h @ p["A"] + p["a"])
        score = np.where(mask, key @ p["v"], -np.inf)
        top = np.where(mask.any(1), score.max(1, initial=-np.inf, where=mask), 0)
        e = np.exp(score - top[:, None])
        alpha = e / np.maximum(e.sum(1, keepdims=True), 1e-9)
        pooled = np.einsum("bt,bth->bh", alpha, h)
        logit = pooled @ p["o"] + p["c"][0]
        return (logit, trace, h, key, alpha, pooled) if keep else logit

    def grads(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
        p = self.p
        logit, trace, h, key, alpha, pooled = self.run(x, at, mask, keep=True)
        d = ((_sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["o"], g["c"] = pooled.T @ d, np.array([d.sum()], np.float32)
        dpooled = d[:, None] * p["o"][None, :]
        dh = alpha[:, :, None] * dpooled[:, None, :]
        dalpha = np.einsum("bh,bth->bt", dpooled, h)
        dscore = alpha * (dalpha - (alpha * dalpha).sum(1, keepdims=True))
        g["v"] = np.einsum("bt,bth->h", dscore, key)
        dkey = dscore[:, :, None] * p["v"] * (1 - key * key)
        g["A"], g["a"] = np.einsum("bti,btj->ij", h, dkey), dkey.sum((0, 1))
        dh += dkey @ p["A"].T
        dx = np.zeros_like(x)
        m = mask.astype(np.float32)[:, :, None]
        back = {"f": None, "b": None}
        for side, t, before, z, r, new, un in reversed(trace):
            part = slice(0, HIDDEN) if side == "f" else slice(HIDDEN, 2 * HIDDEN)
            dnext = dh[:, t, part] + (0 if back[side] is None else back[side])
            live = dnext * m[:, t]
            dz, dn = live * (before - new) * z * (1 - z), live * (1 - z) * (1 - new * new)
            dr = dn * un * r * (1 - r)
            dgate = np.concatenate([dz, dr, dn], axis=1)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            back[side] = dnext * (1 - m[:, t]) + live * z + du @ p["U" + side].T
            g["U" + side] += before.T @ du
            g["W" + side] += x[at[:, t]].T @ (dgate * m[:, t])
            g["b" + side] += (dgate * m[:, t]).sum(0)
            np.add.at(dx, at[:, t], (dgate * m[:, t]) @ p["W" + side].T)
        return g, dx, logit

    def logits(self, column: pa.Array) -> np.ndarray:
        """The logit of each text's worst window, worked out for some 2 MB of texts at a time."""
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        found = [self._logits(part.column(0)) for part in W.slices(batch, "text", _PIECE)]
        return np.concatenate(found) if found else np.zeros(0, np.float32)

    def _logits(self, column: pa.Array) -> np.ndarray:
        words = W.Words(column, _FLAGS)
        n = words.per_text()
        x, own = self.inputs(words)
        x = np.concatenate([x, np.zeros((1, 2 * DIM), np.float32)])
        which = np.append(own["which"], len(x) - 1)
        text, start = windows(n)
        first = np.cumsum(n) - n
        out = np.empty(len(text), np.float32)
        for a in range(0, len(text), 4096):
            at = start[a: a + 4096, None] + np.arange(WINDOW)[None, :]
            mask = at < n[text[a: a + 4096], None]
            at = np.where(mask, at + first[text[a: a + 4096], None], len(which) - 1)
            out[a: a + 4096] = self.run(x, which[at], mask)
        return np.maximum.reduceat(out, np.flatnonzero(np.append(True, text[1:] != text[:-1]))) if len(out) else out

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(column), self.constant)
        return _sigmoid(self.scale * self.logits(column).astype(np.float64) + self.shift)


def _association(a: np.ndarray, b: np.ndarray, toxic: float, clean: float) -> np.ndarray:
    """How many standard errors the log odds of the label are from none, given counts with either label."""
    odds = np.log((a + 0.5) / (toxic - a + 0.5)) - np.log((b + 0.5) / (clean - b + 0.5))
    return odds / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))


def _gram_association(words: W.Words, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for n-grams, which count once for each distinct word of each text.

    Counted by 22 bits of the hash first, then exactly for those in the strongest places: memory is bounded.
    """
    bits, low, high = 22, np.zeros(1 << 22), np.zeros(1 << 22)
    chunks = range(0, len(first), 20_000)
    for at in chunks:
        owner, gram = _grams(words, first[at: at + 20_000])
        place = (gram >> np.uint64(64 - bits)).astype(np.int64)
        for total, c in ((high, a), (low, b)):
            total += np.bincount(place, c[at + owner], len(total))
    strong = np.zeros(1 << bits, bool)
    strong[np.argsort(-np.abs(_association(high, low, a.sum(), b.sum())), kind="stable")[: 2 * ENTRIES]] = True
    found, ca, cb = [], [], []
    for at in chunks:
        owner, gram = _grams(words, first[at: at + 20_000])
        keep = strong[(gram >> np.uint64(64 - bits)).astype(np.int64)]
        found.append(gram[keep]), ca.append(a[at + owner[keep]]), cb.append(b[at + owner[keep]])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0)
    items, which = np.unique(np.concatenate(found), return_inverse=True)
    counts = (np.bincount(which, np.concatenate(c), len(items)) for c in (ca, cb))
    return items, _association(*counts, a.sum(), b.sum())


def _best(items: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keep = np.sort(np.lexsort((items, -np.abs(z)))[:ENTRIES])
    return items[keep], z[keep]


def train(texts: pa.Array, y: np.ndarray) -> Network:
    """Fits the network to whole texts and their labels (0 or 1); every sixth text only sets where the score is 0.5."""
    aside = np.arange(len(y)) % 6 == 5
    net = _train(texts.filter(pa.array(~aside)), y[~aside])
    rest = y[aside].astype(np.float64)
    if net.constant is None:
        some = len(rest) and rest.min() < rest.max()
        part, target = (texts.filter(pa.array(aside)), rest) if some else (texts, y.astype(np.float64))
        net.scale, net.shift = _calibrate(net.logits(part).astype(np.float64), target)
    return net


def _train(texts: pa.Array, y: np.ndarray) -> Network:
    y = y.astype(np.float64)
    if not len(y) or y.min() == y.max():
        return Network(np.zeros(0, np.uint64), np.zeros(0, np.uint64), {}, constant=float(y.mean()) if len(y) else 0.0)
    rng = np.random.default_rng(7)
    words = W.Words(texts, _FLAGS)
    _, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
    pair = np.unique(which.astype(np.int64) * len(y) + words.text)
    a, b = (np.bincount(pair // len(y), y[pair % len(y)] == label, len(first)) for label in (1, 0))
    del pair
    items, z = words.hash[first], _association(a, b, y.sum(), (1 - y).sum())
    gitems, gz = _gram_association(words, first, a, b)
    known, known_z = _best(items, z)
    grams, grams_z = _best(gitems, gz)

    def table(z: np.ndarray) -> np.ndarray:
        out = rng.normal(0, 0.1, (len(z) + 1, DIM)).astype(np.float32)
        out[0] = 0
        out[1:, 0] = z / 2
        return out

    def weights(a: int, b: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(a), (a, b)).astype(np.float32)

    p = {"E": table(known_z), "G": table(grams_z), "A": weights(2 * HIDDEN, HIDDEN), "a": np.zeros(HIDDEN, np.float32),
         "v": weights(HIDDEN, 1)[:, 0], "o": weights(2 * HIDDEN, 1)[:, 0], "c": np.zeros(1, np.float32)}
    for side in "fb":
        p |= {"W" + side: weights(2 * DIM, 3 * HIDDEN), "U" + side: weights(HIDDEN, 3 * HIDDEN), "b" + side: np.zeros(3 * HIDDEN, np.float32)}
    net = Network(known, grams, p)
    n = words.per_text()
    doc, start = windows(n)
    begin_word = np.cumsum(n) - n
    # the strongest word of each window decides which windows of a toxic text are examples
    strength = np.append(z[_lookup(words.hash, items) - 1] if len(items) else [], -9.0)
    at = start[:, None] + np.arange(WINDOW)[None, :]
    mask = at < n[doc, None]
    at = np.where(mask, at + begin_word[doc, None], len(words.hash))
    peak = strength[at].max(1) if len(at) else np.zeros(0)
    best = np.full(len(n), -99.0)
    np.maximum.at(best, doc, peak)
    label = y[doc] > 0
    toxic = label & (peak >= np.maximum(0.7 * best[doc], 1.0)) | label & (peak == best[doc])
    clean = np.flatnonzero(~label)
    # clean windows: half with the strongest words, half any
    half = SAMPLE_WINDOWS // 2
    hard = clean[np.lexsort((clean, -peak[clean]))[: half // 2]]
    other = rng.permutation(clean)[: half]
    chosen = np.unique(np.concatenate([rng.permutation(np.flatnonzero(toxic))[:half], hard, other]))
    target = toxic[chosen].astype(np.float32)
    balance = np.where(target > 0, 0.5 / max(target.mean(), 1e-6), 0.5 / max(1 - target.mean(), 1e-6)).astype(np.float32)
    which = np.append(which, len(first))
    _, own = net.inputs(words)
    grams_of = np.append(np.searchsorted(own["owner"], np.arange(len(first))), len(own["owner"]))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    batches = max(1, len(chosen) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    total = epochs * batches
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(chosen)), batches):
            rows = chosen[batch]
            used, local = np.unique(which[at[rows]], return_inverse=True)  # the last may stand for no word
            real = used[used < len(first)]
            size = own["count"][real].astype(np.int64)
            gram = own["gram"][np.repeat(grams_of[real] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            owner = np.repeat(np.arange(len(real)), size)
            x = np.zeros((len(used), 2 * DIM), np.float32)
            x[: len(real), :DIM] = p["E"][own["word"][real]]
            for d in range(DIM):
                x[: len(real), DIM + d] = np.bincount(owner, p["G"][gram, d], len(real)) * own["weight"][real]
            x[: len(real), DIM:][size == 0] = p["G"][0]
            g, dx, _ = net.grads(x, local.reshape(len(rows), WINDOW), mask[rows], target[batch], balance[batch])
            np.add.at(g["E"], own["word"][real], dx[: len(real), :DIM])
            np.add.at(g["G"], gram, dx[owner, DIM:] * own["weight"][real][owner, None])
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for k, v in p.items():
                m1, m2 = moments[k]
                m1 += 0.1 * (g[k] - m1)
                m2 += 0.01 * (g[k] ** 2 - m2)
                v -= (rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit of the label to the worst window's logit, lightly held back; the slope is never negative.

    The logits are centred and scaled first, and a Newton step is halved until it lowers the loss: where the classes are
    all but apart, whole steps run back and forth over the fit.
    """
    middle, spread = x.mean(), x.std() or 1.0
    u, held = (x - middle) / spread, 0.1 / spread**2

    def loss(a: float, b: float) -> float:
        m = a * u + b
        return float((np.logaddexp(0, m) - y * m).sum() + held / 2 * a * a + 0.005 * b * b)

    a, b = 1.0, 0.0
    now = loss(a, b)
    for _ in range(100):
        q = _sigmoid(a * u + b)
        w = q * (1 - q) + 1e-6
        ga, gb = ((q - y) * u).sum() + held * a, (q - y).sum() + 0.01 * b
        haa, hab, hbb = (w * u * u).sum() + held, (w * u).sum(), w.sum() + 0.01
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = 1.0
        while step > 1e-6 and not (then := loss(max(1e-3, a - step * da), b - step * db)) < now:
            step /= 2
        if step <= 1e-6:
            break
        gained, now, a, b = now - then, then, max(1e-3, a - step * da), b - step * db
        if gained < 1e-9:
            break
    return float(a / spread), float(b - a * middle / spread)


def held_out():
    """Rows whose labels are never learned from: the checksum of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Network:
    """Trains on at most ``rows`` labelled texts of at most ``chars`` characters, each text once; never on held-out ones.

    Rows without a label or id are left out. With no labels, or with one class only, the network is a constant: the
    share of toxic rows.
    """
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    # as many ids as `rows` at most; texts no longer than `chars`
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = (
        texts.filter(F.char_length("text") <= chars).join(F.broadcast(ids), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .groupBy("text").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    )

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id").combine_chunks()
        net = train(table.column("text").combine_chunks(), table.column("toxic").to_numpy())
        W.release()
        return pa.table({"network": pa.array([pickle.dumps(net)], pa.binary())})

    # the sample's bound makes it one task's work; the driver gets the network only
    made = sample.groupBy().applyInArrow(learn, "network binary").collect()
    return pickle.loads(made[0].network) if made else train(pa.array([], pa.string()), np.zeros(0))


def score(docs: DataFrame, net: Network) -> DataFrame:
    """Every row with ``held_out, score, predicted``; input columns of these names are replaced, others pass.

    Whole texts; a null, empty or wordless text has the score of a window without words. Only the text decides, so
    repeated texts score alike. No shuffle.
    """
    rows = without(docs, "held_out", "score", "predicted")
    source = fresh(rows, "_text")
    names = [c for c in rows.columns]
    sent = docs.sparkSession.sparkContext.broadcast(net)  # ENTRIES bounds its size: under 1 MB

    def run(batches):
        net = sent.value
        for batch in (part for whole in batches for part in W.slices(whole, source, _PIECE)):
            out = net.scores(batch.column(source))
            kept = [i for i, c in enumerate(batch.schema.names) if c != source]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(out, pa.float64())], names=[*names, "score"])
        W.release()

    scored = rows.withColumn(source, text_or_empty()).mapInArrow(run, f"{ddl(rows)}, score double")
    return scored.withColumn("held_out", held_out()).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
