"""Chat formatting by event sourcing: conversation logs folded into final messages, then rendered.

Logs are dealt out by conversation and sorted by sequence. A first pass goes backwards and tells which events still
count: an edit or a regeneration makes what its message said before void, a regeneration also the later messages that
were there. A second pass goes forwards, joins the deltas of each message and renders it. Both passes are streams over
sorted rows that keep one message and one part of a rendered conversation, so a conversation of any length is spilled
by the sort and never held as a whole.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOSS_ROLE = "assistant"
PART = 1 << 22  # code points of a rendered conversation in one row, before the next turn begins a new one
PIECES = 3  # a streamed text comes in so many deltas

LOG = "conv_id long, seq long, part int, message long, entry string, kind string, role string, text string"
_KEPT = "conv_id long, message long, entry string, seq long, part int, kind string, role string, text string"
FORMATTED = "conv_id long, part int, formatted string, loss array<struct<start: int, end: int>>"
READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_CONTROL = re.compile(r"\\|<(?=/?turn)")
_IN_ROLE = re.compile(r"[\\<>\n]")
_TURN = re.compile(r"<turn ((?:\\.|[^\\>])*)>\n(.*?)\n</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    """The text with a backslash before each backslash and each ``<`` that begins a control string."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn, and where its text lies in it."""
    head, body = f"<turn {_IN_ROLE.sub(r'\\\g<0>', role)}>\n", escape(text)
    return f"{head}{body}\n</turn>\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a rendered conversation, or of some whole turns of one."""
    out, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}: {formatted[at: at + 40]!r}")
        out.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return out


def _rows(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows, ddl_names, types, size, most: int = 8 << 20):
    """Rows as batches of about so many characters."""
    held, weight = [], 0
    schema = pa.schema(list(zip(ddl_names, types, strict=True)))

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        weight += size(row)
        if weight > most or len(held) == 4096:
            yield batch()
            held, weight = [], 0
    if held:
        yield batch()


_L, _I, _S = pa.int64(), pa.int32(), pa.string()


def _valid(batches):
    """Backwards through each conversation: only what still counts goes on, text that is void as null."""

    def rows():
        now, low, closed = ..., None, set()
        for conv, seq, part, message, entry, kind, role, text in _rows(batches):
            if conv != now or now is ...:
                now, low, closed = conv, None, set()
            if low is not None and message > low:
                continue  # a regeneration of an earlier message came later
            key = (message, entry)
            if key in closed:
                text = None  # but a role that the event names still counts
                if kind == "message":
                    closed.discard(key)  # an edit is of the last message of its number
            if kind in ("edit", "regenerate"):
                closed.add(key)
                if kind == "regenerate":
                    low = message
            yield conv, message, entry, seq, part, kind, role, text

    names = ("conv_id", "message", "entry", "seq", "part", "kind", "role", "text")
    yield from _batches(rows(), names, (_L, _L, _S, _L, _I, _S, _S, _S), lambda r: len(r[7] or "") + 50)


def _messages(batches):
    """Forwards: (conversation, role, text) of every message, its pieces joined."""
    now, role, pieces = ..., "", []
    for conv, message, entry, _, _, kind, of_role, text in _rows(batches):
        key = (conv, message, entry)
        if key != now or kind == "message":
            if now is not ...:
                yield now[0], role, "".join(pieces)
            now, role, pieces = key, "", []
        role = of_role if of_role is not None else role
        pieces.append(text or "")
    if now is not ...:
        yield now[0], role, "".join(pieces)


def _render(part_chars: int, loss_role: str):
    def rows(batches):
        now, part, text, size, spans = ..., 0, [], 0, []
        for conv, role, said in _messages(batches):
            if now is ... or conv != now or size >= part_chars:
                if now is not ...:
                    yield now, part, "".join(text), spans
                part = part + 1 if now is not ... and conv == now else 0
                now, text, size, spans = conv, [], 0, []
            turn, begin, end = render(role, said)
            if role == loss_role:
                spans.append({"start": size + begin, "end": size + end})
            text.append(turn)
            size += len(turn)
        if now is not ...:
            yield now, part, "".join(text), spans

    def run(batches):
        span = pa.list_(pa.struct([("start", _I), ("end", _I)]))
        yield from _batches(rows(batches), ("conv_id", "part", "formatted", "loss"), (_L, _I, _S, span), lambda r: len(r[2]))

    return run


def log_of_turns(turns: DataFrame, pieces: int = PIECES) -> DataFrame:
    """A log from a table of finished turns (``conv_id, turn, role, text``): a message per row, whose text is streamed.

    Every row is a message of its own. Rows that share a turn are ordered by a hash of role and text; a null turn comes
    first, a null role or text is an empty one.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    # only tells apart rows that are alike in everything else
    entry = F.concat_ws("-", F.hex(F.xxhash64(role, text)), F.monotonically_increasing_id().cast("string"))
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63)))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), entry.alias("entry"), role.alias("role"), text.alias("text"))
    step = F.greatest(F.lit(1), F.ceil(F.char_length("text") / F.lit(pieces))).cast("int")
    begins = F.filter(F.array(*[step * i for i in range(pieces)]), lambda b: b < F.char_length("text"))
    delta = F.transform(begins, lambda b: F.struct(
        (F.floor(b / step) + 1).cast("int").alias("part"), F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"),
        F.col("text").substr(b + 1, step).alias("text")))
    opened = F.array(F.struct(F.lit(0).alias("part"), F.lit("message").alias("kind"), F.col("role").alias("role"), F.lit("").alias("text")))
    events = rows.select("conv_id", F.col("turn").alias("seq"), F.col("turn").alias("message"), "entry", F.explode(F.concat(opened, delta)).alias("e"))
    return events.select("conv_id", "seq", "e.part", "message", "entry", "e.kind", "e.role", "e.text")


def format(log: DataFrame, loss_role: str = LOSS_ROLE, part_chars: int = PART) -> DataFrame:
    """``conv_id, part, formatted, loss``: every conversation of a log, rendered, with the spans that the loss counts.

    A log has the columns of ``LOG``; others are ignored. Events count in the order of ``seq, entry, part``; a
    message is told by its number ``message`` and, where several share one, by ``entry``. Kinds: ``message`` (a message
    begins, with its role and maybe text), ``delta`` (more text), ``edit`` (the text is replaced, all earlier pieces are
    void), ``regenerate`` (the same, and messages of higher numbers that were logged before are void as well). Messages
    are rendered in the order of their numbers. A message that nothing names a role for has an empty one; a null text
    is an empty one; null ids are one conversation; null numbers come first. An empty log gives an empty result.

    A conversation is one row, part 0, unless it is longer than ``part_chars``: then a further part begins with the
    next turn. ``loss`` holds spans in code points of ``formatted``, the escaped text of each turn of ``loss_role``.
    Control strings and backslashes inside texts and roles are escaped by a backslash, see ``parse`` for the way back.
    """
    first = -(1 << 63)
    events = log.select(
        F.col("conv_id").cast("long").alias("conv_id"), *[F.coalesce(F.col(c).cast(t), F.lit(d).cast(t)).alias(c) for c, t, d in (
            ("seq", "long", first), ("part", "int", 0), ("message", "long", first), ("entry", "string", ""))],
        F.col("kind").cast("string").alias("kind"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    backwards = events.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.desc("seq"), F.desc("entry"), F.desc("part"))
    kept = backwards.mapInArrow(_valid, _KEPT).sortWithinPartitions("conv_id", "message", "entry", "seq", "part")
    return kept.mapInArrow(_render(part_chars, loss_role), FORMATTED)


def _read(batches):
    """Turns and loss text of rendered conversations, taken from nothing but ``formatted`` and ``loss``."""

    def rows():
        now, n, chars, loss_chars, turns, loss = ..., 0, 0, 0, None, None
        for conv, part, formatted, spans in _rows(batches):
            if part == 0:
                if now is not ...:
                    yield now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars
                now, n, chars, loss_chars, turns, loss = conv, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            for role, text in parse(formatted):
                turns.update(f"{role}\n{text}\n".encode())
                n += 1
            for span in spans:
                text = unescape(formatted[span["start"]: span["end"]])
                loss.update(text.encode())
                loss_chars += len(text)
            chars += len(formatted)
        if now is not ...:
            yield now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    yield from _batches(rows(), names, (_L, _L, _S, _L, _S, _L), lambda r: 200)


def read_back(formatted: DataFrame) -> DataFrame:
    """What ``READ`` names, of every conversation, read from rendered rows in the order in which ``format`` gives them."""
    return formatted.select("conv_id", "part", "formatted", "loss").mapInArrow(_read, READ)
