"""The source audit against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import divergence
from tests.llm.conftest import DOCUMENTS, ODD

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plainly(rows, least, top):
    """rows of (text, lang, source)"""
    rows = [tuple(x or "" for x in r) for r in rows]
    found = [(lang, source, TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))) for text, lang, source in rows]
    out = []
    for lang in {r[0] for r in found}:
        docs = Counter(t for x, _, terms in found if x == lang for t in set(terms))
        kept = {t for t, n in docs.items() if n >= least}
        sources = sorted({s for x, s, _ in found if x == lang}, key=str.encode)
        count = {s: Counter(t for x, y, terms in found if (x, y) == (lang, s) for t in terms if t in kept) for s in sources}
        total = sum(count.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        for s in sources:
            pairs = [(sum(abs(share(count[s], t) - share(count[o], t)) for t in kept), o) for o in sources if o != s]
            terms = [(share(count[s], t) - share(total, t), t) for t in kept if count[s][t]]
            for part, values, most in (("pair", pairs, None), ("term", [v for v in terms if v[0] > 0], top)):
                ranked = sorted(values, key=lambda v: (-v[0], v[1].encode()))[:most]
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, text, lang, source, None) for i, (text, lang, source) in enumerate(rows)], DOCUMENTS)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


@pytest.mark.parametrize("terms, sources, size", [(4096, 256, 1 << 20), (7, 3, 200)])
def test_equals_plain_counting(spark, terms, sources, size):
    r = random.Random(terms)
    words = ["a", "Ab", "abcdefgh", "abcdefghi", "abcdefghijklmnopq", "abcdefghijklmnopr", "Éa", "漢字", "x1y", "z"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = [(" ".join(r.choices(words, k=r.randint(0, 30))), r.choice(["en", "de", None]), r.choice([f"s{k}" for k in range(9)] + [None])) for _ in range(300)]
    rows += [(None, "fr", "a"), ("", "fr", "b"), ("only here", "it", "a")]
    assert got(divergence.audit(frame(spark, rows), 20, 5, terms, sources, size)) == plainly(rows, 20, 5)


def test_odd_rows(spark, odd):
    more = odd.withColumn("term", F.lit(1)).withColumn("n", F.lit("x")).withColumn("p", F.lit(0))
    assert got(divergence.audit(more, 2)) == plainly([(t, "en", "s") for _, t in ODD], 2, 50) == []
    one = odd.withColumn("source", F.col("doc_id").cast("string"))
    assert got(divergence.audit(one, 1)) == plainly([(t, "en", None if i is None else str(i)) for i, t in ODD], 1, 50)
    assert got(divergence.audit(odd.limit(0))) == []


def test_pointer_sort():
    texts = sorted({random.Random(k).choice(["", "ab", "abcdefgh"]) + "abcdefgh"[: k % 9] + chr(97 + k % 3) * (k % 20) + "e" for k in range(200)})
    chosen = random.Random(1).choices(texts, k=500)
    data = np.frombuffer("".join(chosen).encode(), np.uint8)
    size = np.array([len(x) for x in chosen])
    part = np.array([k % 3 for k in range(500)])
    order, new = divergence.pointer_sort(data, np.cumsum(size) - size, np.cumsum(size), part)
    assert [(part[i], chosen[i], i) for i in order] == sorted((part[i], x, i) for i, x in enumerate(chosen))
    assert new.sum() == len({(part[i], x) for i, x in enumerate(chosen)})
