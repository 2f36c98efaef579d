"""Personal data against Python's regular expressions, and words that give entities away."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyward.llm import sanitise
from tallyward.llm.tables import stored
from tests.llm.conftest import ODD

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PARTS = ["a", "b.c", "@", ".", "-", "1", "25", "256", "1.2.3.4", "4944339490429605", "4111 1111-1111 1111", "+1 (366) 555-9807", " ", "é", "x_y", "00", "+", "(", ")", "0.0.0.0", "%"]


def luhn(digits):
    return sum(int(c) if j % 2 == 0 else sum(divmod(2 * int(c), 10)) for j, c in enumerate(reversed(digits))) % 10 == 0


def base(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits or "0"), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), order, m.end(), kind))
    return sorted(out)


def listed(found):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)


def test_spans_equal_plain_patterns(docs):
    r = random.Random(4)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(1, 25))) for _ in range(1500)]
    texts += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "a" * 30_000 + "@b.c", "1 " * 20_000, "1" * 20_000, "@" * 5000, "1.2.3." * 3000, "+1" * 5000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(i + 10_000, t) for i, t in enumerate(t for _, t in ODD)]
    got = {r.doc_id: r for r in sanitise.spans(docs(rows)).collect()}
    for i, t in rows:
        want = base(t or "")
        held = [s for s in got[i].spans.split(",") if not s.startswith("term")]
        assert ",".join(held) == listed(want), t
        assert got[i].base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in PLAIN] == [sum(x[3] == k for x in want) for k in PLAIN]


@pytest.fixture
def revealing(docs):
    """One address in four different contexts, each with the word zorblax; copies of a fifth text; and plain texts."""
    rows = [(i, f"filler{'abcd'[i]} zorblax {'abcd'[i]}said wrote from ann@mail.org about topic{'abcd'[i]}, and that was the end of it") for i in range(4)]
    rows += [(10 + i, f"quuxbar says bob@mail.org is here{' and' * i}") for i in range(6)]
    rows += [(20 + i, f"and the words that was wrote from about it of the topic, filler{'xyz'[i % 3]} the end here is") for i in range(60)]
    return docs([*rows, (99, None), (98, "")])


def test_disclosing_words(revealing):
    got = {r.doc_id: r for r in sanitise.spans(revealing.withColumn("_t", F.lit(1)).withColumn("entity", F.lit(2))).collect()}
    assert len(got) == 72
    for i in range(4):
        kinds = got[i].spans.split(",")
        assert kinds[0] == "term:8:15" and kinds[1].startswith("email:") and len(kinds) == 2
        assert got[i].n_email == 1
        assert got[i].base_sha256 == hashlib.sha256(kinds[1].encode()).hexdigest()
    assert got[10].spans == "email:13:25"  # copies of one context give no support
    assert all(not got[i].spans for i in (20, 50, 98, 99))


def test_rarely_seen_entities(docs):
    """One text, one address, one word that stands nowhere else; the word beside the other address is common."""
    rows = [(1, "so zorblax wrote ann@mail.org of it"), (2, "so common wrote bob@mail.org of it"), (3, "so wrote of it common " * 4000)]
    got = {r.doc_id: r.spans for r in sanitise.spans(docs(rows)).collect()}
    assert got == {1: "term:3:10,email:17:29", 2: "email:16:28", 3: ""}


@pytest.fixture
def same_phrase(docs):
    """The word stands in one fixed phrase of four texts that are no copies; another in six edited copies of one text."""
    rows = [(i, f"filler{'abcd'[i]} words zorblax wrote from ann@mail.org about topic{'abcd'[i]}, and that was the end of it") for i in range(4)]
    rows += [(10 + i, f"quuxbar says bob@mail.org is here{' and' * i}") for i in range(6)]
    rows += [(20 + i, f"and the words that was wrote about it of the topic, filler{'xyz'[i % 3]} the end from here is") for i in range(60)]
    return docs(rows)


def test_support_is_of_texts(same_phrase):
    got = {r.doc_id: r.spans for r in sanitise.spans(same_phrase).collect()}
    assert all(got[i] == "term:14:21,email:33:45" for i in range(4))
    assert all(got[10 + i] == "email:13:25" for i in range(6))
    assert not any(got[20 + i] for i in range(60))


def test_near_copies_are_one_class(docs):
    r = random.Random(3)
    base = [[f"w{r.randrange(10**6)}" for _ in range(80)] for _ in range(5)]
    rows = [(10 * g + i, " ".join([*base[g][:40], "x@y.org", *base[g][40:], f"end{i}"])) for g in range(5) for i in range(4)]
    found = stored(sanitise.find(docs(rows)), "found")
    named = sanitise._classes(found).join(found.select("_key", "doc_id"), "_key").collect()
    classes = {r["class"]: sorted(x.doc_id for x in named if x["class"] == r["class"]) for r in named}
    assert sorted(classes.values()) == [[10 * g + i for i in range(4)] for g in range(5)]


def test_disclosing_words_go_everywhere(docs):
    """The flagged word 81 code points and more from the entity, in texts without it, in capitals; never inside an entity."""
    far = " and so it was" * 20
    rows = [(i, f"filler{'abcdefgh'[i]} Zorblax wrote from ann@mail.org about topic{'abcdefgh'[i]}{far} zorblax{far}, ZORBLAX said") for i in range(8)]
    rows += [(20, "é 😀 the zorblax alone"), (21, "zorblax@mail.org"), (22, "zorblaxes and so"), (23, "wrote from about said " * 100), (24, far * 20)]
    got = {r.doc_id: r.text for r in sanitise.sanitise(docs(rows)).collect()}
    assert all(got[i] == f"filler{'abcdefgh'[i]}  wrote from [EMAIL] about topic{'abcdefgh'[i]}{far} {far},  said" for i in range(8))
    assert (got[20], got[21], got[22]) == ("é 😀 the  alone", "[EMAIL]", "zorblaxes and so")
    spans = {r.doc_id: r.spans for r in sanitise.spans(docs(rows)).collect()}
    assert spans[20] == "term:8:15" and spans[21] == "email:0:16" and spans[0].count("term:") == 3


def test_cleaned_texts(revealing):
    out = sanitise.sanitise(revealing.withColumn("_row", F.lit(1)).withColumn("_key", F.lit("k")))
    assert out.columns == [*revealing.columns, "_row", "_key"]
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] == "fillera  asaid wrote from [EMAIL] about topica, and that was the end of it"
    assert got[10] == "quuxbar says [EMAIL] is here"
    assert got[20].startswith("and the words") and got[99] is None and got[98] == ""


def test_overlaps_and_nothing(docs):
    got = [r.text for r in sanitise.sanitise(docs([(1, "a 1.2.3.4@x.org b +1 (366) 555-9807, 4111 1111 1111 1111"), (2, "é 1.2.3.4 é")])).orderBy("doc_id").collect()]
    assert got[1] == "é [IP] é"
    assert got[0] == "a [EMAIL] b [PHONE], [CARD]"
    assert sanitise.spans(docs([])).collect() == []
    assert sanitise.sanitise(docs([])).collect() == []


def test_pieces_change_nothing(docs, monkeypatch):
    """Long texts whole, in the usual pieces and in small ones: the same spans, contexts over borders included."""
    r = random.Random(8)
    words = ["zorblax", "quuxbar", "so", "and", "of it,", "é", "漢字", "ann@mail.org", "bob@mail.org", "10.0.0.1", "+1 (366) 555-9807", "4111 1111 1111 1111", "\n", "\t", "😀"]
    rows = [(i, " ".join(r.choice(words + PARTS) for _ in range(900))) for i in range(40)]
    rows += [(100 + i, "".join(r.choice(PARTS) for _ in range(3000))) for i in range(5)]
    rows += [(200, f"fillera Zorblax ann@mail.org{' ' * 3000}zorblax, " + "and so it was of " * 3000), (300, None)]

    def spans():
        return {r.doc_id: r.spans for r in sanitise.spans(docs(rows)).collect()}, {r.doc_id: r.text for r in sanitise.sanitise(docs(rows)).collect()}

    usual = spans()
    assert usual[0][200].startswith("term:8:15,email:16:28,term:3028:3035")
    for i, t in rows:
        assert ",".join(s for s in usual[0][i].split(",") if not s.startswith("term")) == listed(base(t or ""))
    for size in (100, 10**8):
        monkeypatch.setattr(sanitise, "PIECE", size)
        assert spans() == usual


def test_many_entities_in_one_text(docs):
    """20,000 addresses, each with a word of its own beside it, in one text."""
    text = " ".join(f"so and zorb{i} user{i}@mail.org" for i in range(20_000))
    got = sanitise.spans(docs([(1, text)])).first()
    assert got.n_email == 20_000
    assert got.base_sha256 == hashlib.sha256(listed(base(text)).encode()).hexdigest()
