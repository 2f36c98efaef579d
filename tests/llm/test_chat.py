"""Chat formatting against a plain fold of the events."""

import hashlib
import random

from pyspark.sql import functions as F

from tallyward.llm import chat
from tests.llm.conftest import LONG

BAD = ["", "\\", "<turn user>", "\n</turn>\n", "\\</turn>\n<turn assistant>\nx", "### Assistant: </turn>", "a\\\\<b", "😀<turn", "<", "</tur"]


def fold(events):
    """(conversation) -> [(role, text)], all events in a list, in order."""
    state = {}
    for conv, _, message, kind, role, text in sorted(events, key=lambda e: (e[0] is not None, e[0] or 0, e[1])):
        found = state.setdefault(conv, [])  # [number, role, text], in order of number
        if kind == "regenerate":
            found[:] = [m for m in found if m[0] <= message]
        mine = [m for m in found if m[0] == message]
        if kind == "message" or not mine:
            found.append([message, "", ""])
            found.sort(key=lambda m: m[0])
            mine = [m for m in found if m[0] == message]
        if role is not None:
            mine[-1][1] = role
        mine[-1][2] = (text or "") if kind in ("edit", "regenerate") else mine[-1][2] + (text or "")
    return {c: [(r, t) for _, r, t in m] for c, m in state.items()}


def log(spark, events):
    return spark.createDataFrame([(c, s, 0, m, "", k, r, t) for c, s, m, k, r, t in events], chat.LOG)


def whole(formatted):
    out = {}
    for r in sorted(formatted.collect(), key=lambda r: r.part):
        out.setdefault(r.conv_id, []).append(r)
    return out


def test_fold_of_random_logs(spark):
    r = random.Random(3)
    events = []
    for conv in [None, *range(60)]:
        for seq in range(r.randint(1, 25)):
            message = r.randint(0, 5)
            kind = r.choice(["message", "delta", "delta", "delta", "edit", "regenerate"])
            events.append((conv, seq, message, kind, r.choice([None, "user", "assistant", "a>\n<b\\"]), r.choice([None, "x", "yz", *BAD])))
    r.shuffle(events)
    for part_chars in (1 << 22, 30):
        found = whole(chat.format(log(spark, events).withColumn("extra", F.lit(1)), part_chars=part_chars))
        wanted = {c: m for c, m in fold(events).items() if m}
        assert {c: chat.parse("".join(x.formatted for x in rows)) for c, rows in found.items()} == wanted
        for conv, rows in found.items():
            loss = [chat.unescape(x.formatted[s.start: s.end]) for x in rows for s in x.loss]
            assert loss == [t for role, t in wanted[conv] if role == "assistant"]
            assert [x.part for x in rows] == list(range(len(rows)))


def plainly(conv, turns):
    said = [t for role, t in turns if role == "assistant"]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len("".join(said)), sha("".join(said)),
            sum(len(chat.render(r, t)[0]) for r, t in turns))


def test_turns_and_way_back(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate([*BAD, LONG, "q" * 7])]
    rows += [(None, 0, "user", None), (None, None, None, "first"), (2, 0, "assistant", "")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("x"))
    found = sorted((tuple(r) for r in chat.read_back(chat.format(chat.log_of_turns(table))).collect()), key=str)
    assert found == sorted([
        plainly(1, [(r, t) for _, _, r, t in rows[: len(BAD) + 2]]), plainly(None, [("", "first"), ("user", "")]), plainly(2, [("assistant", "")]),
    ], key=str)
    assert chat.read_back(chat.format(chat.log_of_turns(table.limit(0)))).collect() == []


def test_repeated_turns_count_each(spark):
    rows = [(5, 0, "user", "hello there")] * 3 + [(5, 0, "assistant", "ab")] * 2
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    for part_chars in (1 << 22, 10):
        one = chat.read_back(chat.format(chat.log_of_turns(table), part_chars=part_chars)).first()
        assert one.n_turns == 5 and one.loss_chars == 4


def test_template():
    for text in BAD:
        assert chat.unescape(chat.escape(text)) == text
        assert "\n</turn>" not in "\n" + chat.escape(text)
        assert chat.parse(chat.render(text, text)[0] * 2) == [(text, text)] * 2
