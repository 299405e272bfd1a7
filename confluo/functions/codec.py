"""Compact codes of keys, lengths and endings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First character of the 64-sign alphabet (fixed value).
FIRST = 45
#: Endings and their letters in the compact file (fixed values).
ENDINGS = {
    "error": "e", "player": "p", "timeout": "t", "silence": "s", "loop": "l", "volume": "v", "repeat": "r",
    "player+silence": "b", "player+volume": "P", "loop+silence": "i", "loop+volume": "L", "nosound": "n",
}
#: Milliseconds of a step of the compact file, and the sign of a duplicate part (fixed values).
STEP, DUPLICATE = 20, "!"


def base64_digits(value: Column, digits: int, minimise: bool = False) -> Column:
    """A long as so many base-64 signs, most significant first; ``minimise`` takes leading zeros off, and leaves one."""
    signs = [F.char(F.lit(FIRST) + F.shiftright(value, 6 * (digits - 1 - i)).bitwiseAND(63)) for i in range(digits)]
    code = F.concat(*signs)
    zero = chr(FIRST)
    return F.when(value == 0, F.lit(zero)).otherwise(F.regexp_replace(code, f"^[{zero}]+", "")) if minimise else code


def base64_value(code: Column) -> Column:
    """The long of base-64 signs."""
    return F.aggregate(F.split(code, ""), F.lit(0).cast("long"), lambda n, c: F.when(c == "", n).otherwise(n * 64 + F.ascii(c) - FIRST))


def content_key(digest: Column) -> Column:
    """The first 48 bits of a hexadecimal digest as a long."""
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def quantise(ms: Column) -> Column:
    """Milliseconds as rounded steps of 20; 0 stays 0, any other length is one step at least."""
    shown = F.when((ms > 0) & (ms < STEP), F.lit(STEP)).otherwise(ms)
    return F.floor((shown + STEP // 2) / STEP).cast("long")


def ending_code(ending: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in ENDINGS.items() for x in pair])[ending]


def ending_name(code: Column) -> Column:
    return F.create_map(*[F.lit(x) for name, letter in ENDINGS.items() for x in (letter, name)])[code]


def lengths_line(entries: Column) -> Column:
    """Compact line of an array of structs (length in ms, end, duplicate): entries parted by spaces.

    An entry is the steps in base 64, then the letter of an ending other than `player`, then `!` for a duplicate.  One that
    equals the one before it in length and ending is left empty, or is `!` alone.  Null endings are `player`.
    """

    def told(e: Column) -> Column:
        steps = base64_digits(quantise(F.coalesce(e["length"], F.lit(0)).cast("long")), 4, True)
        end = F.coalesce(e["end"], F.lit("player"))
        return F.when(end == "player", steps).otherwise(F.concat(steps, F.lit(","), ending_code(end)))

    plain = F.transform(entries, lambda e: F.struct(told(e).alias("t"), F.coalesce(e["duplicate"], F.lit(False)).alias("d")))

    def line(all_: Column) -> Column:
        def shown(e: Column, i: Column) -> Column:
            same = (i > 0) & (e["t"] == F.get(all_, i - 1)["t"])
            return F.when(same, F.when(e["d"], DUPLICATE).otherwise("")).otherwise(F.concat(e["t"], F.when(e["d"], "," + DUPLICATE).otherwise("")))

        return F.array_join(F.transform(all_, shown), " ")

    return F.get(F.transform(F.array(plain), line), F.lit(0))


def parse_lengths(line: Column) -> Column:
    """The inverse of :func:`lengths_line`: an array of structs (length, end, duplicate), lengths in steps of 20 ms."""
    kind = "struct<length:long,end:string,duplicate:boolean>"
    first = F.struct(F.lit(0).cast("long").alias("length"), F.lit("error").alias("end"), F.lit(False).alias("duplicate"))

    def read(text: Column) -> Column:
        parts = F.split(text, ",")
        steps, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
        return F.struct(
            F.when(steps == "", F.lit(0)).otherwise(base64_value(steps) * STEP).cast("long").alias("length"),
            F.when(second.isNull() | (second == DUPLICATE), F.lit("player")).otherwise(ending_name(second)).alias("end"),
            F.coalesce(F.get(parts, F.size(parts) - 1) == DUPLICATE, F.lit(False)).alias("duplicate"),
        )

    def step(done: Column, text: Column) -> Column:
        before = F.coalesce(F.get(done, F.size(done) - 1), first)
        again = F.struct(before["length"].alias("length"), before["end"].alias("end"), (text == DUPLICATE).alias("duplicate"))
        return F.concat(done, F.array(F.when((text == "") | (text == DUPLICATE), again).otherwise(read(text))))

    return F.aggregate(F.split(line, " "), F.array().cast(f"array<{kind}>"), step)
