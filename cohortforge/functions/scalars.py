"""Column functions for labels, identifiers, paths, values and times.  All stay in the JVM; null gives null unless noted."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Conversion factors, recoded literals, file kinds.
POUNDS_PER_KILOGRAM = 2.20462
INCHES_PER_CENTIMETRE = 0.393701
MONTH_LIKE_RANGES = {"4-Mar": "3 - 4", "6-May": "5 - 6", "9-Jul": "7 - 9"}
FILE_FORMATS = {"tsv": "format:3475", "json": "format:3464", "parquet": "format:4006", "wav": "format:3996", "csv": "format:3752"}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_label(c) -> Column:
    """Lower case, every run of other than letters and digits one hyphen, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "-"), F.lit("-"))


def sanitize_task_entity(stem) -> Column:
    """A file stem with the label of its task entity normalised and the rest as it was."""
    s = col(stem)
    split = F.split(F.regexp_replace(s, "^(.*?(?:^|_)task-)([^_]*)(.*)$", "$1\u0001$2\u0001$3"), "\u0001")
    # a lambda, so that the parts are made once
    one = F.transform(F.array(split), lambda parts: F.when(F.size(parts) == 3, F.concat(parts[0], normalize_label(parts[1]), parts[2])).otherwise(s))
    return one[0]


def recording_to_task_name(name) -> Column:
    """Lower case, spaces as hyphens, a bracketed part kept without its brackets."""
    return F.regexp_replace(F.replace(F.lower(col(name)), F.lit(" "), F.lit("-")), r"-\(([^)]+)\)", r"-$1")


def strip_counters(name) -> Column:
    """A label without the numbers counted up at its end."""
    return F.regexp_replace(col(name), r"(-\d+)+$", "")


def file_stem(path) -> Column:
    """A path's file name without its last extension; a leading dot begins none."""
    return F.regexp_replace(F.element_at(F.split(col(path), "/"), -1), r"(?<=.)\.[^.]+$", "")


def path_entity(path, entity: str) -> Column:
    """The value of sub-, ses- or task- in a path: its folder first, then its file name; null if there is none."""
    p = col(path)
    folder = F.regexp_extract(p, f"(?:^|/){entity}-([^/]+)/", 1)
    stem = F.regexp_extract(p, f"(?:^|[/_]){entity}-([^_/.]+)", 1)
    return F.coalesce(F.nullif(folder, F.lit("")), F.nullif(stem, F.lit("")))


def recording_parts(name) -> Column:
    """participant, session, task and extension of a recording's file name; null if it isn't one."""
    pattern = r"^sub-([^_]+)_ses-([^_]+)_task-(.+)\.(wav|json)$"
    part = lambda i: F.regexp_extract(col(name), pattern, i)
    return F.when(col(name).rlike(pattern), F.struct(part(1).alias("participant"), part(2).alias("session"), part(3).alias("task"), part(4).alias("extension")))


def canonical_stem(stem) -> Column:
    """A stem up to its task entity, or the whole stem without one."""
    return F.regexp_replace(col(stem), "^(.*?(?:^|_)task-[^_]*).*$", "$1")


def reduce_id(c, n: int = 8) -> Column:
    return F.substring(F.replace(col(c), F.lit("-"), F.lit("")), 1, n)


def keyed_digest(c, key: bytes) -> Column:
    """HMAC-SHA256 as lower-case hex, from hash functions alone."""
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    padded = key.ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ x for b in padded)) for x in (0x36, 0x5C))
    first = F.unhex(F.sha2(F.concat(inner, F.encode(col(c), "UTF-8")), 256))
    return F.sha2(F.concat(outer, first), 256)


def pseudonym(c, key: bytes, digits: int = 6) -> Column:
    """A keyed number of fixed width: 12 hex digits of the keyed digest, modulo a power of ten."""
    value = F.conv(F.substring(keyed_digest(c, key), 1, 12), 16, 10).cast("long") % 10**digits
    return F.lpad(value.cast("string"), digits, "0")


def upper_amount(c) -> Column:
    """The amount that ends a label such as "$50,000 to $74,999"; null if none does."""
    return F.regexp_replace(F.regexp_extract(col(c), r"\$(\d+,\d+)\s*$", 1), ",", "").try_cast("double")


def elapsed_ms(start, end, subsecond_only: bool = False) -> Column:
    """Whole milliseconds between two times; ``subsecond_only`` keeps the part below a second."""
    micros = F.unix_micros(col(end)) - F.unix_micros(col(start))
    return F.floor((F.pmod(micros, F.lit(1_000_000)) if subsecond_only else micros) / 1000).cast("long")


def parse_instant(c) -> Column:
    return F.try_to_timestamp(col(c), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSS]'Z'"))


def imperial(value, factor: float, unit) -> Column:
    """Metric values as imperial whole numbers (half to even); other units stay."""
    return F.when(col(unit) == "Metric", F.bround(col(value) * factor)).otherwise(col(value))


def clean_value(c) -> Column:
    """Text without apostrophes; whole floats without their fraction."""
    text = F.replace(col(c), F.lit("'"), F.lit(""))
    number = text.try_cast("double")
    return F.when(text.rlike(r"^-?\d+\.0+$"), number.cast("long").cast("string")).otherwise(text)


def capitalized(c) -> Column:
    return F.concat(F.upper(F.substring(col(c), 1, 1)), F.lower(F.substring(col(c), 2, 1 << 30)))


def lookup(c, mapping: dict[str, str], default=None) -> Column:
    """A small fixed map applied; ``default`` (null by itself) for what it lacks."""
    table = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    found = F.try_element_at(table, col(c))
    return found if default is None else F.coalesce(found, col(default) if not isinstance(default, Column) else default)


def file_format(path) -> Column:
    return lookup(F.lower(F.regexp_extract(col(path), r"\.([^./]+)$", 1)), FILE_FORMATS)


def whole_number(c) -> Column:
    return col(c).try_cast("long")


def normalized_answer(c) -> Column:
    """Checked and Unchecked as true and false, "nan" as null, underscores as hyphens."""
    text = col(c)
    return F.when(F.lower(text) == "nan", None).when(text == "Checked", "true").when(text == "Unchecked", "false").otherwise(F.replace(text, F.lit("_"), F.lit("-")))


def no_answer(*cols) -> Column:
    """Whether all answers are missing or unchecked."""
    return F.forall(F.array(*(F.coalesce(F.lower(col(c)), F.lit("nan")) for c in cols)), lambda x: x.isin("nan", "unchecked", ""))


def camel_case(c) -> Column:
    words = F.split(F.trim(F.regexp_replace(col(c), "[^A-Za-z0-9]+", " ")), " ")
    joined = F.concat_ws("", F.transform(words, lambda w: F.initcap(w)))
    return F.concat(F.lower(F.substring(joined, 1, 1)), F.substring(joined, 2, 1 << 30))


def slug(c) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(col(c)), r"[^\w]+", "_"), "^_+|_+$", "")


def first_text(*cols) -> Column:
    """The first of several texts that is neither null nor empty."""
    return F.coalesce(*(F.nullif(col(c), F.lit("")) for c in cols))


def import_cell(c, mapping: dict[str, str] | None = None) -> Column:
    """A cell as the importing side wants it: mapped, states as numbers, whole floats as integers."""
    text = F.trim(col(c))
    low = F.lower(text)
    out = F.when(low.isin("checked", "v1.0.0"), "1").when(low == "unchecked", "0").when(low.isin("completed", "consented", "canada"), "2")
    out = out.otherwise(clean_value(text))
    return F.coalesce(lookup(text, mapping), out) if mapping else out
