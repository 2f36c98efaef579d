"""Text in and out: base64, JSON, names, formats."""

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward import schemas as S

CORRUPT = "_corrupt_record"


def base64_text(data: Column) -> Column:
    """base64 to UTF-8 text; null when either step fails."""
    return F.try_validate_utf8(F.try_to_binary(data, F.lit("base64")).cast("string"))


_MODE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _read(text: Column, item: str) -> tuple[Column, Column]:
    """The text read as the only item of an array, and what must hold so that it is one.

    A reader stops behind the first JSON value and says nothing of what follows; inside an array more text is an
    error or a second item. Text that closes the array itself shows as a second key.
    """
    wrapped = F.concat(F.lit('{"r":['), text, F.lit("]}"))
    read = F.from_json(wrapped, f"r array<{item}>, {CORRUPT} string", _MODE)
    return read, F.when(text.contains("]"), F.size(F.json_object_keys(wrapped)) == 1).otherwise(True)


def is_one_value(text: Column) -> Column:
    """Whether the text is one JSON value and nothing else."""
    read, whole = _read(text, "string")
    return F.coalesce(read[CORRUPT].isNull() & (F.size(read["r"]) == 1) & whole, F.lit(False))


def with_record(df: DataFrame, text: Column, schema: T.StructType, out: str,
                otherwise: Callable[[Column], Column] | None = None) -> DataFrame:
    """Adds ``out``: the text as a record of the declared types, null where it is no such record and nothing else.

    ``otherwise`` gives the record of a text that is none, from that text.
    """
    read, _ = _read(text, schema.simpleString())

    def record(r: Column) -> Column:
        _, whole = _read(r["_of"], "string")
        fine = r["_read"][CORRUPT].isNull() & (F.size(r["_read"]["r"]) == 1) & whole
        found = F.when(fine, r["_read"]["r"][0])
        return F.struct((found if otherwise is None else F.coalesce(found, otherwise(r["_of"]))).alias(out))

    # inline makes Spark read and check the text once, whatever is asked of the record: an expression would be worked
    # out again for each field and each filter
    return df.select("*", F.inline(F.transform(F.array(F.struct(read.alias("_read"), text.alias("_of"))), record)))


def unread(text: Column, schema: T.StructType) -> Column:
    """Why a text gave no record: ``extra_data`` behind a record, or ``bad_json``."""
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    alone = F.from_json(text, wide, _MODE)
    more = alone.isNotNull() & alone[CORRUPT].isNull() & ~is_one_value(text)
    return F.when(more, "extra_data").otherwise("bad_json")


def json_text(*columns) -> Column:
    return F.to_json(F.struct(*columns))


def plain_name(text: Column) -> Column:
    """``'London, UK'`` to ``london_uk``: one rule for training and serving."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_")


def plain_name_of(text: str) -> str:
    """The same rule for a name known to the driver."""
    return re.sub("[^a-z0-9]+", "_", text.lower())


def short_name(text: Column) -> Column:
    """Older spelling that only joins at the comma and keeps inner blanks."""
    return F.lower(F.replace(text, F.lit(", "), F.lit("_")))


def risk_factors() -> Column:
    """What an alert shows of its transaction, one text per field."""
    shown = {"is_vpn": F.initcap(F.col("is_vpn").cast("string"))}
    return F.array(
        F.format_string(S.RISK_FACTOR_AMOUNT, "amount"),
        *[F.concat(F.lit(label), shown.get(c, F.col(c))) for c, label in S.RISK_FACTOR_LABELS.items()],
    )


def percent(value: Column) -> Column:
    return F.format_string("%.2f%%", value * 100)


def csv_text(names: list[str], present: list[str]) -> Column:
    """Feature values as comma text in the given order; what is missing is ``0``."""
    have = set(present)
    return F.concat_ws(",", *[
        F.coalesce(F.col(n).cast("string"), F.lit("0")) if n in have else F.lit("0") for n in names
    ])


def fit_width(values: Column, width: int) -> Column:
    """Array padded with ``'0'`` or cut to ``width``."""
    return F.slice(F.concat(values, F.array_repeat(F.lit("0"), width)), 1, width)
