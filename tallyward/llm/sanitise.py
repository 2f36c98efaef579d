"""Personal data: patterns for what is personal in itself, information theory for what gives it away.

Email addresses, IP addresses, card and phone numbers are the protected entities. A word that keeps standing near one
of them tells who is meant even when the entity itself is gone. How much it tells is the share of the entity's
information content that the word carries,

    disclosure = PMI(entity; word) / IC(entity) = 1 + log2 P(entity | word) / IC(entity),

with P(entity | word) = occurrences of the word in texts where it stands near the entity / its occurrences in the corpus and
IC(entity) = -log2(occurrences of the entity / words of the corpus). P(entity | word) is held back by how little was seen:
n texts that are no near copies count n / (n + 1/2), as if half a text more had the word without the entity. So an entity
seen once is served too, when the corpus is large enough that this half says little beside the entity's information
content. Words at or above a threshold are protected as well, in every text and wherever they stand in it. DataFrame
functions only.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.components import components
from tallyward.llm.tables import fresh, stored, text_or_empty

KINDS = ("email", "ip", "card", "phone", "term")
CONTEXT = 80  # code points either side of an entity
DISCLOSURE = 0.95
UNSEEN = 0.5  # so many texts are taken to have the word without the entity
SHINGLE, ALIKE = 3, 0.75  # near copies share so much of their runs of words
BANDS, IN_BAND = 16, 4  # smallest hashes that near copies are looked up by
SMALL = 64 << 20  # bytes that may be broadcast
PIECE = 2_048  # code points (CONTEXT at least) after which a text is cut, at the next place that nothing is matched across
TERM = r"\p{L}{2,}"
# The patterns match what the plain ones in the contract match, but never go back over a run of characters:
# a match can only begin where such a run begins, or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",  # shorter ones are dropped anyway
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Behind a character that no pattern takes, or between a blank and a letter.
_CUT = r"(?:(?<=[^\p{L}0-9._%+@\x20()-])|(?<=\x20)(?=\p{L})|\z)"
_HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_SPAN = "array<struct<start:int,kind:int,end:int>>"
_MATCH = "array<struct<start:int,end:int,match:string>>"
_PIECES = "array<struct<at:int,text:string>>"


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pieces(text: Column) -> Column:
    """The text in pieces that no match reaches across, each with the place (``at``) where it begins.

    All that compares the matches of a text with each other stays within a piece and its neighbours, so the work grows with the
    text, not with its square. Only a run without any place to cut stays whole.
    """
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_PIECES).alias("out"))

    def add(acc: Column, piece: Column) -> Column:
        one = F.struct(acc["at"].alias("at"), piece.alias("text"))
        return F.struct((acc["at"] + F.char_length(piece)).alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    cut = F.aggregate(F.regexp_extract_all(text, F.lit(rf"(?s).{{{PIECE},}}?{_CUT}|.+"), F.lit(0)), begin, add)["out"]
    return F.when(F.char_length(text) <= PIECE, F.array(F.struct(F.lit(0).alias("at"), text.alias("text")))).otherwise(cut)


def _matches(text: Column, pattern: str) -> Column:
    """Start, end (code points) and text of the matches of a pattern."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_MATCH).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["0"])
        end = start + F.char_length(x["1"])
        one = F.struct(start.alias("start"), end.alias("end"), x["1"].alias("match"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    zipped = F.arrays_zip(between.alias("0"), found.alias("1"))
    return F.when(text.rlike(pattern), F.aggregate(zipped, begin, add)["out"]).otherwise(F.array().cast(_MATCH))


def _luhn(digits: Column) -> Column:
    def part(i: Column) -> Column:
        d = F.substring(digits, F.char_length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    parts = F.transform(F.sequence(F.lit(0), F.char_length(digits) - 1), part)
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^(?:{_PART}\.){{3}}{_PART}$")
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.char_length(digits).between(12, 19) & _luhn(digits)
    return F.char_length(digits).between(9, 15)


def entities(text: Column, kind: str) -> Column:
    """The valid matches of a kind: leftmost, none over another; a match that fails is dropped, nothing is tried in its place."""
    found = F.filter(_matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["match"]))
    hint = _HINTS[kind]
    return found if hint is None else F.when(text.contains(hint), found).otherwise(F.array().cast(_MATCH))


def _words(text: Column) -> Column:
    """The words of a text in lower case, repeats included."""
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower)


def _found(piece: Column) -> Column:
    """The entities of all kinds in a piece, by start, then kind."""

    def of(i: int):
        return lambda m: F.struct(m["start"].alias("start"), F.lit(i).alias("kind"), m["end"].alias("end"), m["match"].alias("match"))

    return F.sort_array(F.concat(*[F.transform(entities(piece, k), of(i)) for i, k in enumerate(PATTERNS)]))


def _moved(spans: Column, by: Column) -> Column:
    return F.transform(spans, lambda s: F.struct((s["start"] + by).alias("start"), s["kind"].alias("kind"), (s["end"] + by).alias("end")))


def _reached(pieces: Column, found: Column) -> Column:
    """Each entity with the text to its ``left`` and ``right`` and the ``others`` (itself too) that may hold a word of it.

    Places are those of the piece with what lies ``CONTEXT`` either side of it.
    """
    names = F.array(*[F.lit(k) for k in PATTERNS])

    def of_piece(f: Column, i: Column) -> Column:
        own, last, following = F.get(pieces, i), F.get(pieces, i - 1), F.get(pieces, i + 1)
        before = F.coalesce(F.right(last["text"], F.lit(CONTEXT)), F.lit(""))
        after = F.coalesce(F.left(following["text"], F.lit(CONTEXT)), F.lit(""))
        by = F.char_length(before)

        def beside(j: Column, at: Column) -> Column:
            moved = F.coalesce(_moved(F.get(found, j), at - own["at"] + by), F.array().cast(_SPAN))
            return F.filter(moved, lambda x: (x["end"] > 0) & (x["start"] < by + F.char_length(own["text"]) + CONTEXT))

        wide = F.struct(
            F.concat(before, own["text"], after).alias("text"), by.alias("by"),
            F.concat(beside(i - 1, last["at"]), _moved(f, by), beside(i + 1, following["at"])).alias("near"))

        def within(w: Column) -> Column:
            def one(e: Column) -> Column:
                start, end = e["start"] + w["by"], e["end"] + w["by"]
                lo = F.greatest(F.lit(0), start - CONTEXT)
                others = F.filter(w["near"], lambda x: (x["start"] < end + CONTEXT) & (start - CONTEXT < x["end"]))
                return F.struct(
                    F.xxhash64(F.element_at(names, e["kind"] + 1), F.lower(e["match"])).alias("entity"), lo.alias("lo"), end.alias("end"),
                    ((i == 0) & (lo == 0)).alias("first"), others.alias("others"),
                    F.substring(w["text"], lo + 1, start - lo).alias("left"), F.substring(w["text"], end + 1, F.lit(CONTEXT)).alias("right"))

            return F.transform(f, one)

        return F.when(F.size(f) > 0, _named(wide, within))

    return F.flatten(F.array_compact(F.transform(found, of_piece)))


def _contexts(reached: Column) -> Column:
    """Per entity: its name, and the words near it that are no part of an entity."""
    def one(e: Column) -> Column:
        def near(part: Column, offset: Column, whole: Column) -> Column:
            words = F.filter(_matches(part, TERM), lambda w: whole | (w["start"] > 0) & (w["end"] < F.char_length(part)))
            free = F.filter(words, lambda w: ~F.exists(e["others"], lambda x: (x["start"] < w["end"] + offset) & (w["start"] + offset < x["end"])))
            return F.transform(free, lambda w: F.lower(w["match"]))

        left, right = near(e["left"], e["lo"], e["first"]), near(e["right"], e["end"], F.char_length(e["right"]) < CONTEXT)
        # a word cut off at the outer edge isn't known
        return F.struct(e["entity"].alias("entity"), F.array_distinct(F.concat(left, right)).alias("words"))

    return F.when(F.size(reached) > 0, F.transform(reached, one))


def _in_pieces(rows: DataFrame) -> DataFrame:
    """The rows with their text ``_t`` cut into ``_pieces`` and the entities ``_found`` in each."""
    rows = rows.select("*", _pieces(F.col("_t")).alias("_pieces"))
    return rows.select("*", F.transform("_pieces", lambda p: _found(p["text"])).alias("_found"))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """What each row's text holds by pattern alone, stored: ``key`` (of the text), spans by piece, contexts, words.

    Of texts that hold an entity all words are kept, and the shingles that tell near copies.
    """
    t = F.col("_t")
    pieces, found = F.col("_pieces"), F.col("_found")
    rows = _in_pieces(docs.withColumn("_t", text_or_empty(text)))
    parts = F.transform(F.arrays_zip(pieces, found), lambda x: F.struct(
        x["_pieces"]["at"].alias("at"), _moved(x["_found"], F.lit(0)).alias("spans")))
    # columns of their own, so that lambdas name them instead of working them out anew
    rows = rows.select("*", parts.alias("_parts"), _reached(pieces, found).alias("_reached"))
    kept = [c for c in docs.columns if c != text]
    held = F.size("_reached") > 0
    return rows.select(
        *kept, F.md5(t.cast("binary")).alias("_key"), "_parts", _contexts(F.col("_reached")).alias("_contexts"),
        F.when(held, _words(t)).alias("_terms"), F.when(held, _shingles(t)).alias("_shingles"),
        F.regexp_count(t, F.lit(TERM)).cast("long").alias("_words"))


def _shingles(text: Column) -> Column:
    """Hashes of the distinct runs of ``SHINGLE`` words between blanks; a shorter text is one run."""

    def runs(words: Column) -> Column:
        last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
        return F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(words, i + 1, SHINGLE))))

    return _named(F.regexp_extract_all(F.lower(text), F.lit(r"\S+"), F.lit(0)), runs)


def _classes(found: DataFrame) -> DataFrame:
    """``_key, class`` of texts that have a near copy, where that matters: they hold an entity that other texts hold as well.

    Texts whose shingles are alike (``ALIKE`` of their union) are linked, and linked texts are one class. Candidates share
    a band of smallest hashes; each is compared, on whole sets, with one text of its band, so that no group makes all pairs.
    """
    holds = found.select("_key", F.explode("_contexts.entity").alias("entity")).distinct()
    shared = holds.groupBy("entity").agg(F.count("*").alias("texts")).filter("texts > 1").select("entity")
    keys = holds.join(shared, "entity").select("_key").distinct()
    texts = found.filter("_shingles IS NOT NULL").groupBy("_key").agg(F.any_value("_shingles").alias("set")).join(keys, "_key", "left_semi")
    texts = stored(texts.select("_key", F.xxhash64("_key").alias("node"), "set"), "entity-texts")
    least = F.transform(F.sequence(F.lit(0), F.lit(BANDS * IN_BAND - 1)), lambda j: F.array_min(F.transform("set", lambda s: F.xxhash64(s, j))))
    bands = texts.select("node", least.alias("least")).select("node", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.slice("least", b * IN_BAND + 1, IN_BAND)))))
    bands = stored(bands.select("node", F.col("col").alias("band")), "entity-bands")
    centres = bands.groupBy("band").agg(F.min("node").alias("centre"), F.count("*").alias("texts")).filter("texts > 1")
    pairs = bands.join(centres, "band").filter("node <> centre").select("node", "centre").distinct()
    sets = texts.select("node", "set")
    pairs = pairs.join(sets, "node").join(sets.select(F.col("node").alias("centre"), F.col("set").alias("other")), "centre")
    common = F.size(F.array_intersect("set", "other"))
    linked = pairs.filter(common >= ALIKE * (F.size("set") + F.size("other") - common)).select("node", "centre")
    named = components(linked, "node", "centre").withColumnRenamed("root", "class")
    return texts.select("_key", "node").join(named, "node").select("_key", "class")


def disclosing(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame | None:
    """``entity, word`` where the word gives the entity away, from counts over all texts; None when there are none.

    Near copies count once towards the support, so copies of one text, exact or edited elsewhere, can't make its words
    disclosing; the same words in texts that are no copies do count.
    """
    near = found.select("_key", F.explode("_contexts").alias("c")).select("_key", "c.entity", F.explode("c.words").alias("word")).distinct()
    counts = found.select("_key", F.explode("_terms").alias("word")).groupBy("_key", "word").agg(F.count("*").alias("n"))
    near = near.join(counts, ["_key", "word"]).join(_classes(found), "_key", "left")
    pairs = (
        near.groupBy("entity", "word", F.coalesce("class", F.xxhash64("_key")).alias("class")).agg(F.sum("n").alias("n"))
        .groupBy("entity", "word").agg(F.count("*").alias("support"), F.sum("n").alias("near"))
    )
    pairs = stored(pairs, "disclosing")
    words = pairs.select("word").distinct()
    size = words.agg(F.sum(F.octet_length("word") + 32)).first()[0]
    if not size:
        return None
    corpus = docs.select(F.explode(_words(text_or_empty(text))).alias("word"))
    if size <= SMALL:
        counts = corpus.join(F.broadcast(words), "word", "left_semi").groupBy("word").agg(F.count("*").alias("all"))
    else:
        counts = corpus.groupBy("word").agg(F.count("*").alias("all")).join(words, "word", "left_semi")
    seen = found.select(F.explode("_contexts.entity").alias("entity")).groupBy("entity").agg(F.count("*").alias("seen"))
    total = found.agg(F.sum("_words")).first()[0]
    content = -F.log2(F.col("seen") / F.lit(float(max(total, 1))))
    sure = F.col("support") / (F.col("support") + UNSEEN)
    disclosure = 1 + F.log2(F.least(F.lit(1.0), F.col("near") / F.col("all")) * sure) / F.greatest(content, F.lit(1.0))
    return pairs.join(counts, "word").join(seen, "entity").filter(disclosure >= DISCLOSURE).select("entity", "word")


def protect(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row without its text, with ``_base`` and ``_spans`` (``array<struct<start, kind, end>>``, by start, then kind).

    ``_base`` has the pattern spans, ``_spans`` those and the disclosing words (kind ``term``), wherever they stand.
    Offsets are code points, ends exclusive. A null text counts as empty; equal texts have equal spans.
    """
    found = stored(find(docs, text), "entities")
    extra = _extra(docs, disclosing(docs, found, text), text)
    base = F.flatten(F.transform("_parts", lambda p: _moved(p["spans"], p["at"])))
    if extra is None:
        return found.select("*", base.alias("_base"), base.alias("_spans")).drop("_parts")
    spans = F.flatten(F.transform("_parts", lambda p, i: _moved(_with_extra(p["spans"], i), p["at"])))
    return found.join(extra, "_key", "left").select("*", base.alias("_base"), spans.alias("_spans")).drop("_extra", "_parts")


def _few(df: DataFrame, size: Column) -> DataFrame:
    """The rows, for broadcast if their bytes are few."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= SMALL else df


def _extra(docs: DataFrame, flagged: DataFrame | None, text: str = "text") -> DataFrame | None:
    """``_key, _extra``: where texts hold disclosing words, with or without the entity, a row per text.

    ``_extra`` has the pieces with such words, in order, and the ``spans`` within each. Texts are dealt by
    their digest only when the lists of words to look for in them pass ``SMALL`` bytes.
    """
    if flagged is None:
        return None
    flagged = _few(stored(flagged.select("word").distinct(), "disclosing-words"), F.octet_length("word") + 32)
    t = text_or_empty(text)
    pieces = docs.select(F.md5(t.cast("binary")).alias("_key"), F.posexplode(_pieces(t)).alias("piece", "p"))
    pieces = pieces.select("_key", "piece", "p.text")
    held = pieces.select("_key", "piece", F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
    held = held.join(flagged, "word", "left_semi").groupBy("_key", "piece").agg(F.collect_set("word").alias("held"))
    held = _few(stored(held, "disclosing-texts"), 64 + F.octet_length(F.array_join("held", "")) + 16 * F.size("held"))
    placed = pieces.join(held, ["_key", "piece"]).select("_key", "piece", _places(F.col("text"), F.col("held")).alias("spans"))
    placed = placed.groupBy("_key", "piece").agg(F.any_value("spans").alias("spans"))
    extra = stored(placed.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("piece", "spans"))).alias("_extra")), "disclosed")
    return _few(extra, 64 + F.aggregate("_extra", F.lit(0), lambda a, x: a + 64 + 32 * F.size(x["spans"])))


def _places(piece: Column, held: Column) -> Column:
    """The spans of these words in a piece."""
    found = F.regexp_extract_all(piece, F.lit(TERM), F.lit(0))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["0"])
        end = start + F.char_length(x["1"])
        one = F.struct(start.alias("start"), F.lit(KINDS.index("term")).alias("kind"), end.alias("end"))
        out = F.when(F.array_contains(held, F.lower(x["1"])), F.concat(acc["out"], F.array(one))).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    # what comes after the last word has no word
    zipped = F.filter(F.arrays_zip(F.split(piece, TERM, -1).alias("0"), found.alias("1")), lambda x: x["1"].isNotNull())
    return F.aggregate(zipped, begin, add)["out"]


def _with_extra(spans: Column, piece: Column) -> Column:
    """A piece's spans with the disclosing words that are no part of an entity."""
    at = F.array_position(F.col("_extra")["piece"], piece).cast("int") - 1
    extra = F.coalesce(F.get(F.col("_extra")["spans"], at), F.array().cast(_SPAN))
    free = F.filter(extra, lambda w: ~F.exists(spans, lambda x: (x["start"] < w["end"]) & (w["start"] < x["end"])))
    return F.sort_array(F.concat(spans, free))


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def spans(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row of ``docs`` (``doc_id, text``)."""
    rows = protect(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))

    def count(i: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == i)).cast("long")

    return rows.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])],
        F.sha2(listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans"))


def cleaned(text: Column, spans: Column) -> Column:
    """The piece with its entities generalised to ``[EMAIL]`` and so on and its disclosing words removed.

    Spans that overlap go together, under the name of the first.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]" if k != "term" else "") for k in KINDS])
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["kind"] + 1))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(new, piece).otherwise(acc["out"]).alias("out"))

    whole = _named(F.aggregate(spans, begin, add), lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows, all columns kept, with a cleaned text; a null text stays null.

    Texts don't move: patterns are matched again in place, and texts that hold disclosing words, if any, are looked up
    by their digest. Repeated rows are cleaned alike. Other columns pass, whatever their names.
    """
    plain = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    found = stored(find(plain), "entities")
    extra = _extra(plain, disclosing(plain, found))
    row = fresh(docs, "_row")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), text_or_empty(f"`{text}`").alias("_t"))
    rows = _in_pieces(rows)
    if extra is not None:
        rows = rows.withColumn("_key", F.md5(F.col("_t").cast("binary"))).join(extra, "_key", "left")

    def clean(x: Column, i: Column) -> Column:
        def done(spans: Column) -> Column:
            return cleaned(x["_pieces"]["text"], spans)

        spans = _moved(x["_found"], F.lit(0))
        return done(spans) if extra is None else _named(_named(spans, lambda s: _with_extra(s, i)), done)

    whole = F.array_join(F.transform(F.arrays_zip("_pieces", "_found"), clean), "")
    done = rows.select(row, whole.alias("_t"))
    old = F.col(row)[text]
    return done.select(*[F.when(old.isNotNull(), F.col("_t")).alias(c) if c == text else F.col(row)[c].alias(c) for c in docs.columns])
