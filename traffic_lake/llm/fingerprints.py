"""Fingerprints of texts as multisets of paragraphs, which add up.

A paragraph is a line that isn't blank. Each becomes a wide vector, and the
fingerprint of a text is the sum of its paragraphs' vectors, every entry modulo a
power of two. So the order of paragraphs doesn't matter, and one can be put
in (``plus``) or taken out (``minus``) without the others. The entries of a paragraph are

* 8 numbers of 60 bits, from SHA-256 of the paragraph and of that digest: modulo 2^60, for equality;
* the number of its sentences, modulo 2^31;
* 120 signs per sentence (+1 or -1, bits of MD5), kept as sums of ones modulo
  2^14, four to a number.

The scalar product of two sums of signs estimates how many sentences the texts
share, since the signs of different sentences cancel out. ``likeness`` is twice that over
the squared sizes of both: 1 for equal fingerprints, about 0 (within a tenth) where
nothing is shared. Two texts without paragraphs are alike.

Only DataFrame functions are used. NULL texts count as empty and have a
fingerprint of zeros; texts of any length are read whole. ``compared`` needs a
stored table: NULL ids come first, and rows with equal ids follow each other in
an order that their place in the files fixes. Repeated rows stay apart, an empty
table gives an empty result, and other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Numbers for equality, and their bits.
WIDE, WIDE_BITS = 8, 60
#: Words of 60 sign bits per sentence; a number holds ``FIELDS`` sums, ``APART`` bits apart, each modulo 2^``FIELD_BITS``.
SIGN_WORDS, FIELDS, APART, FIELD_BITS = 2, 4, 15, 14
#: Where sentences end.
SENTENCE = r"[.!?]+[\x20\x09-\x0D]+"

_ONES = sum(1 << (APART * f) for f in range(FIELDS))
_FIELD = (1 << FIELD_BITS) - 1
_MASK = _ONES * _FIELD
_GUARD = _ONES << FIELD_BITS
_COUNT = (1 << 31) - 1
_WIDE = (1 << WIDE_BITS) - 1
_PACKED = SIGN_WORDS * APART
#: Bytes that one task orders, and the most ranges of ids that there are.
RANGE_BYTES, RANGES = 8 << 20, 1 << 14


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _numbers(texts: str, i: int) -> Column:
    """The ``i``-th 15 hexadecimal digits of each text as a number."""
    return F.transform(texts, lambda t: F.conv(F.substring(t, 15 * i + 1, 15), 16, 10).cast("long"))


def _summed(numbers: str, shift: int, bits: int, mask: int) -> Column:
    """The sum of some bits of each number, masked at each step so that it can't overflow."""
    return F.aggregate(numbers, _long(0), lambda total, x: (total + F.shiftright(x, shift).bitwiseAND(_long(bits))).bitwiseAND(_long(mask)))


def with_vector(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with the vector of a text column as an array of 39 numbers."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\n"), lambda p: F.trim(p) != "")
    sentences = F.filter(F.flatten(F.transform(F.col("_lines"), lambda p: F.split(p, SENTENCE))), lambda s: s != "")
    twice = F.transform("_digests", lambda d: F.concat(d, F.sha2(d.cast("binary"), 256)))
    rows = rows.withColumn("_lines", lines).withColumns(
        {"_digests": F.transform("_lines", lambda p: F.sha2(p.cast("binary"), 256)), "_sentences": F.transform(sentences, lambda s: F.md5(s.cast("binary")))}
    )
    rows = rows.withColumn("_digests", twice)
    signs = {f"_signs{w}": _numbers("_sentences", w) for w in range(SIGN_WORDS)}
    wide = {f"_wide{i}": _numbers("_digests", i) for i in range(WIDE)}
    rows = rows.withColumns(signs | wide)
    vector = [_summed(f"_wide{i}", 0, _WIDE, _WIDE) for i in range(WIDE)]
    vector.append(F.size("_sentences").cast("long").bitwiseAND(_long(_COUNT)))
    vector += [_summed(f"_signs{w}", j, _ONES, _MASK) for w in range(SIGN_WORDS) for j in range(APART)]
    return rows.withColumn(out, F.array(*vector)).drop("_lines", "_digests", "_sentences", *signs, *wide)


def _modulus(i: int) -> int:
    return _WIDE if i < WIDE else _COUNT if i == WIDE else _MASK


def plus(a: Column, b: Column) -> Column:
    """The fingerprint of all paragraphs of both vectors."""
    return F.array(*((a[i] + b[i]).bitwiseAND(_long(_modulus(i))) for i in range(WIDE + 1 + _PACKED)))


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of what is left of ``a`` without the paragraphs of ``b``."""
    borrow = lambda i: _modulus(i) + 1 if i <= WIDE else _GUARD
    return F.array(*((a[i] + _long(borrow(i)) - b[i]).bitwiseAND(_long(_modulus(i))) for i in range(WIDE + 1 + _PACKED)))


def as_text(vector: Column) -> Column:
    """Hexadecimal digits, 15 for each entry."""
    return F.lower(F.array_join(F.transform(vector, lambda x: F.lpad(F.hex(x), 15, "0")), ""))


def sums_of_signs(vector: Column) -> Column:
    """The 120 sums of signs as numbers around zero."""
    ones = F.flatten(
        F.transform(
            F.slice(vector, WIDE + 2, _PACKED), lambda x: F.array(*(F.shiftright(x, APART * f).bitwiseAND(_long(_FIELD)) for f in range(FIELDS)))
        )
    )
    span, half = 2 << FIELD_BITS, 1 << FIELD_BITS  # twice a sum of ones, less the number of sentences, is known modulo twice the power
    return F.transform(ones, lambda x: F.pmod(x * 2 - vector[WIDE] + half, _long(span)) - half)


def _product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), _long(0), lambda total, x: total + x)


def likeness(a: Column, b: Column, same: Column) -> Column:
    """How alike two texts are, 0 to 1, by their sums of signs; ``same`` says whether the fingerprints are equal."""
    size = _product(a, a) + _product(b, b)
    return F.when(same, 1.0).when(size == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * _product(a, b) / size)))


def _count(bounds: list[int], matches) -> Column:
    """How many of the sorted bounds match, a condition that holds up to one of them; looked up in two steps."""
    parts = [bounds[i : i + 128] for i in range(0, len(bounds), 128)]
    if not parts:
        return F.lit(0)
    firsts, parts = F.array(*(_long(p[0]) for p in parts)), F.array(*(F.array(*map(_long, p)) for p in parts))
    part = F.size(F.filter(firsts, matches))
    return F.when(part == 0, 0).otherwise((part - 1) * 128 + F.size(F.filter(F.get(parts, part - 1), matches)))


def followed(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, text and vector of each row, and those of the row with the next id (after the last: the first) as ``next`` and ``next_vector``.

    Rows are dealt into ranges of ids of about equal size, an id that fills
    several being cut further; the first row of each range also goes to the end of
    the range before, so that texts are shuffled once and no task has more than a range.
    """
    spark = docs.sparkSession
    place = docs.metadataColumn("_metadata")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(id_col).cast("long"), _long(-(1 << 63))).alias("_id"),
        F.xxhash64(place["file_path"], place["row_index"]).alias("_tie"),
    )
    size = docs.select(F.sum(F.octet_length(text))).first()[0] or 0
    n = int(max(1, min(RANGES, size // RANGE_BYTES)))
    bounds = rows.select(F.percentile_approx("_id", [i / n for i in range(1, n)] or [0.5], 20 * n)).first()[0] or []
    low, high = _count(bounds, lambda b: b < F.col("_id")), _count(bounds, lambda b: b <= F.col("_id"))
    share = F.floor((F.col("_tie") / 2.0**64 + 0.5) * (high - low + 1)).cast("int")
    rows = rows.withColumn("_range", low + F.least(share, high - low))
    heads = sorted((r["_range"], *r["head"]) for r in rows.groupBy("_range").agg(F.min(F.struct("_id", "_tie")).alias("head")).collect())
    guests = [(heads[i - 1][0], *heads[i][1:]) for i in range(len(heads))]
    guests = F.broadcast(spark.createDataFrame(guests, "_range int, _id long, _tie long"))
    guests = rows.drop("_range").join(guests, ["_id", "_tie"])
    both = rows.withColumn("_guest", F.lit(False)).unionByName(guests.withColumn("_guest", F.lit(True)))
    order = Window.partitionBy("_range").orderBy("_guest", "_id", "_tie")
    both = with_vector(both, "text", "vector")
    both = both.withColumns({"next": F.lead("text").over(order), "next_vector": F.lead("vector").over(order)})
    return both.filter("NOT _guest").select("doc_id", "text", "vector", "next", "next_vector")


def compared(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Fingerprint of each text and of the text with its last half replaced by the start of the next.

    Columns: doc_id, n_chars, edited, vector, edited_vector, near_edited and near_next (likeness to the edited and to the next text).
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next", F.lit(1), half))
    rows = followed(docs, text, id_col).withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", edited)
    rows = with_vector(rows, "edited", "edited_vector")
    rows = rows.withColumns({f"_{v}": sums_of_signs(F.col(v)) for v in ("vector", "edited_vector", "next_vector")})
    near = {
        f"near_{name}": likeness(F.col("_vector"), F.col(f"_{name}_vector"), F.col("vector") == F.col(f"{name}_vector"))
        for name in ("edited", "next")
    }
    return rows.withColumns(near).select("doc_id", "n_chars", "edited", "vector", "edited_vector", *near)
