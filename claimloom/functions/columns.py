"""Column expressions, as columns or SQL text. All are built-in functions and stay inside generated code."""

from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def standard_text(name: str) -> Column:
    """Upper case without surrounding spaces (spaces only: a tab is kept)."""
    return F.upper(F.trim(F.col(name)))


def hashed(name: str, salt: str | None = None) -> Column:
    """SHA-256 in lower-case hex; NULL stays NULL."""
    value = F.col(name).cast("string")
    return F.sha2(F.concat(F.lit(salt), value) if salt else value, 256)


def packed_digest(name: str) -> Column:
    """A digest in lower-case hex as half as many bytes, for keys of a shuffle; any other text as its own bytes; NULL stays NULL."""
    text = F.col(name)
    return F.when(F.lower(F.hex(F.unhex(text))) == text, F.concat(F.lit(b"\x01"), F.unhex(text))).otherwise(F.concat(F.lit(b"\x00"), text.cast("binary")))


def unpacked_digest(name: str) -> Column:
    """The text that `packed_digest` took."""
    rest = F.expr(f"substring({name}, 2)")
    return F.when(F.expr(f"substring({name}, 1, 1) = X'01'"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def packed_texts(names: list[str]) -> Column:
    """Several texts in one that sorts as they do one after the other, NULLs last. Each text has a place of its own in a shuffled row, filled
    up to eight bytes, and this has one for all."""

    def packed(name: str) -> Column:
        text = F.replace(F.replace(F.col(name), F.lit("\x01"), F.lit("\x01\x02")), F.lit("\x00"), F.lit("\x01\x01"))
        return F.coalesce(F.concat(F.lit("1"), text), F.lit("2"))

    return F.concat_ws("\x00", *map(packed, names))


def unpacked_text(packed: str, place: int) -> Column:
    """The text that `packed_texts` put in a place, from 0; taken by bytes, as texts may be no UTF-8."""
    part = F.substring_index(F.substring_index(F.col(packed), "\x00", place + 1), "\x00", -1)
    text = F.substring(part.cast("binary"), 2, 2**31 - 1).cast("string")
    return F.when(part != "2", F.replace(F.replace(text, F.lit("\x01\x01"), F.lit("\x00")), F.lit("\x01\x02"), F.lit("\x01")))


def date_of(text: str) -> str:
    """SQL for the date of a `yyyy-MM-dd` text, NULL for anything else."""
    return f"try_to_date({text}, 'yyyy-MM-dd')"


def zero_padded(number: str, width: int) -> str:
    """SQL for a number with zeros up to `width`; longer numbers are kept whole (plain lpad cuts them)."""
    text = f"string({number})"
    return f"lpad({text}, greatest(length({text}), {width}), '0')"


def exact(name: str) -> Column:
    """Accepted amount (see AMOUNT_RANGE) as a decimal, so that a sum does not depend on the order of the rows.

    Spark widens sums by ten digits, which leaves room for 10^12 rows of the largest amount.
    """
    return F.col(name).cast("decimal(20,6)")


def money(total: Column) -> Column:
    """Exact sum as a double with two decimals."""
    return F.round(total.cast("double"), 2)


def mean_money(total: Column, rows: Column) -> Column:
    """Mean from an exact sum and a count, with two decimals."""
    return F.round(total.cast("double") / rows, 2)


def keep_first(df: DataFrame, keys: list[str], order: list[str], rows: int = 1) -> DataFrame:
    """The first row (or `rows` rows) per key in `order`, NULLs last; NULL keys form one group.

    Bounding row_number() lets Spark limit each group on the map side, so a key that holds a large share of the
    rows is cut to that many rows per input partition before the shuffle. Texts that follow each other in `order` are shuffled as one.
    """
    texts = {field.name for field in df.schema if field.dataType == T.StringType()} - set(keys)
    runs = [list(run) for is_text, run in groupby(order, texts.__contains__) if is_text]
    packs = {f"_texts{number}": run for number, run in enumerate(run for run in runs if len(run) > 1)}
    place_of = {name: (pack, place) for pack, run in packs.items() for place, name in enumerate(run)}
    packed = df.select(*[c for c in df.columns if c not in place_of], *[packed_texts(run).alias(pack) for pack, run in packs.items()])
    ordered = dict.fromkeys(place_of[c][0] if c in place_of else c for c in order)
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in ordered])
    first = packed.withColumn("_place", F.row_number().over(window)).where(F.col("_place") <= rows)
    return first.select(*[unpacked_text(*place_of[c]).alias(c) if c in place_of else c for c in df.columns])
