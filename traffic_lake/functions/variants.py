"""Column functions over VARIANT documents.

A key that is absent gives SQL NULL; a key holding an explicit null gives a
VARIANT null, which typed extraction would hide.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runtime type name of each VARIANT type.
KINDS = {
    "STRING": "str",
    "BIGINT": "int",
    "DECIMAL": "float",
    "DOUBLE": "float",
    "FLOAT": "float",
    "BOOLEAN": "bool",
    "VOID": "NoneType",
    "OBJECT": "dict",
    "ARRAY": "list",
    "TIMESTAMP": "datetime",
    "DATE": "datetime",
    "BINARY": "bytes",
}

# Number text as accepted for coordinates: digits may be grouped with "_",
# surrounding blanks are ignored, infinities and nan are words.
NUMBER_TEXT = (
    r"(?i)^\s*[+-]?(inf(inity)?|nan|"
    r"(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?)\s*$"
)


def field(doc: Column, path: str) -> Column:
    """The VARIANT at ``path`` (without the leading ``$.``)."""
    return F.try_variant_get(doc, f"$.{path}", "variant")


def has_field(doc: Column, path: str) -> Column:
    """True when the key exists, an explicit null included."""
    return field(doc, path).isNotNull()


def type_name(value: Column) -> Column:
    """Declared type of a VARIANT, such as ``BIGINT`` or ``OBJECT<...>``.

    It walks the whole value: keep the result in a column when it is needed
    more than once, and test it with the predicates below.
    """
    return F.schema_of_variant(value)


def is_text(name: Column) -> Column:
    return name == "STRING"


def is_whole(name: Column) -> Column:
    return name == "BIGINT"


def is_numeric(name: Column) -> Column:
    """Numbers and booleans, which count as 0 and 1."""
    return name.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)")


def bare_type(value: Column) -> Column:
    """The type without the members of objects and lists: a small set of names."""
    return F.regexp_extract(type_name(value), r"^[A-Z_]+(\(\d+,\d+\))?", 0)


def kind_of(bare: Column) -> Column:
    """Runtime type name for a bare type: str, int, float, bool, NoneType, dict, list, datetime, bytes."""
    # JSON integers beyond 64 bits arrive as DECIMAL(n,0) with n > 18.
    wide_int = bare.rlike(r"^DECIMAL\((19|[23]\d),0\)$")
    pairs = [F.lit(part) for pair in KINDS.items() for part in pair]
    known = F.try_element_at(F.create_map(*pairs), F.regexp_extract(bare, "^[A-Z]+", 0))
    return F.when(wide_int, "int").otherwise(known)


def kind(value: Column) -> Column:
    return kind_of(bare_type(value))


def as_object(value: Column) -> Column:
    """The entries of an object, NULL for every other kind."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def number(value: Column) -> Column:
    """A JSON number or boolean as DOUBLE; number-like text stays NULL."""
    return F.when(is_numeric(type_name(value)), F.try_variant_get(value, "$", "double"))


def parse_number(value: Column) -> Column:
    """Like :func:`number`, but text holding a number is parsed too."""
    text = F.try_variant_get(value, "$", "string")
    parsed = F.when(
        text.rlike(NUMBER_TEXT), F.regexp_replace(F.trim(text), "_", "").try_cast("double")
    )
    return F.when(is_text(type_name(value)), parsed).otherwise(
        F.try_variant_get(value, "$", "double")
    )


def float_text(value: Column) -> Column:
    """Shortest decimal text of a DOUBLE: ``1.0``, ``10000000000.0``, ``1e+16``, ``1e-05``."""
    size = F.abs(value)
    plain = F.regexp_replace(value.cast("string").try_cast("decimal(38,20)").cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    raw = F.regexp_replace(value.cast("string"), r"\.0E", "E")
    power = F.regexp_extract(raw, r"E-?(\d+)$", 1)
    mark = F.when(raw.contains("E-"), "e-").otherwise("e+")
    digits = F.lpad(power, F.greatest(F.length(power), F.lit(2)), F.lit("0"))
    scientific = F.concat(F.regexp_extract(raw, r"^([^E]*)", 1), mark, digits)
    return (
        F.when(value == 0, value.cast("string"))
        .when((size >= 1e-4) & (size < 1e16), plain)
        .when(raw.contains("E"), scientific)
        .otherwise(F.lower(raw))
    )
