"""Statistics of one text as built-in Spark expressions, without user functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: The white space that parts words, and the symbols that are counted.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ"
DIGITS = "0123456789"
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it was with as on be by this are from or an not "
    "le la les de des du et en un une que est pour dans au ce par sur pas avec "
    "der die das und ist in den von zu mit sich des auf für nicht ein eine als im dem "
    "el los las y del se por con para no al lo su como más o pero"
).split()


def let(value: Column, body) -> Column:
    """Evaluate `value` once and use it several times within one expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_of(text: Column, chars: str) -> Column:
    """Characters of `text` that are among `chars`. A pattern's scan is several times faster than translating the text."""
    kind = "".join(c if c.isalnum() else rf"\x{ord(c):02x}" for c in chars)
    return F.regexp_count(text, F.lit(f"[{kind}]")).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(text).cast("long") - count_of(text, SPACE)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[ \t-\r]+"), "")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def repeated_words(w: Column, size: int = 5) -> Column:
    """Words inside windows of `size` words that occur twice or more in the array `w`.

    Windows are compared by a 64-bit hash within one text; texts whose windows
    all differ stop after one distinct count."""

    def covered(hashes: Column) -> Column:
        def places(s: Column) -> Column:
            k = F.size(s) - 1
            twins = F.zip_with(F.slice(s, F.lit(1), k), F.slice(s, F.lit(2), k), lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])).otherwise(F.expr("cast(array() as array<int>)")))
            return F.array_sort(F.array_distinct(F.flatten(twins)))

        def span(p: Column) -> Column:
            k = F.size(p) - 1
            return total(F.zip_with(F.slice(p, F.lit(1), k), F.slice(p, F.lit(2), k), lambda a, b: F.least(F.lit(size), b - a).cast("long"))) + size

        ordered = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return let(ordered, lambda s: let(places(s), span))

    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + d) for d in range(size)]))
    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
    return F.when(F.size(w) <= size, F.lit(0).cast("long")).otherwise(found)


def line_counts(text: Column) -> Column:
    """Struct: lines that hold a word, and those of them equal to an earlier line."""
    full = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    return let(full, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))


def stop_words(w: Column) -> Column:
    forms = sorted({f for x in STOP_WORDS for f in (x, x.capitalize())})
    return F.size(F.filter(w, lambda x: x.isin(forms))).cast("long")


def repeats_before(w: Column) -> Column:
    """Words equal to the word before them."""
    k = F.greatest(F.size(w) - 1, F.lit(0))
    return total(F.zip_with(F.slice(w, F.lit(1), k), F.slice(w, F.lit(2), k), lambda a, b: (a == b).cast("long")))
