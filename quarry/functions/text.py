"""Text scalars as column expressions: no row ever leaves the JVM.

Blank means what Python's ``str.isspace`` means, so the patterns switch Java's
Unicode classes on and name the four separators that Java leaves out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"(?U)[\s\x1C-\x1F]"

# Patterns that results depend on.
TOKEN = r"[a-z0-9_]+"
VARIABLE = r"(?U)\b[A-Z][A-Z0-9]{1,}(?:_[A-Z0-9]+)+\b"
YEAR = r"(?U)\b(?:19|20)\d{2}\b"
ALIAS = r"(?iU)\b(?:also known as|aka|alias(?:es)?|formerly)\b[:\s]+([^.;\n]+)"
SEPARATOR = r"(?U)^\s*[-:–—=]\s+"
VERBS = ("means ", "indicates ", "identifies ", "is ")
DEFINITION_EDGE = " .;:-–—"
SAFE_ID = r"^[A-Za-z0-9][A-Za-z0-9_.-]*$"
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029]"


def text_of(c: Column | str) -> Column:
    """A missing text is the empty one."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{SPACE}+\z|\A{SPACE[4:]}+", "")


def is_blank(c: Column) -> Column:
    return strip(text_of(c)) == ""


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def tokens(c: Column) -> Column:
    """Search tokens; an accented letter separates."""
    return F.regexp_extract_all(F.lower(text_of(c)), F.lit(TOKEN), F.lit(0))


def slug(c: Column) -> Column:
    """Lower case, runs of other than a-z and 0-9 as one hyphen, ``unknown`` if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", F.lit("unknown")).otherwise(s)


def cut_edges(c: Column, characters: str) -> Column:
    return F.btrim(c, F.lit(characters))


def clean_definition(c: Column) -> Column:
    return cut_edges(collapse(c), DEFINITION_EDGE)


def lines(c: Column) -> Column:
    """The collapsed lines of a text that are not blank, in order."""
    return F.filter(F.transform(F.split(text_of(c), LINE_BREAK), collapse), lambda x: x != "")


def variable_names(line: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(line, F.lit(VARIABLE), F.lit(0))))


def definition(line: Column, name: Column) -> Column:
    """What a line says of a name at its first standing as a whole word; NULL: nothing."""
    after = strip(F.call_function("regexp_extract", line, F.concat(F.lit(r"(?sU)\A.*?\b"), name, F.lit(r"\b(.*)\z")), F.lit(1)))
    said = F.when(after.rlike(SEPARATOR), F.regexp_replace(after, SEPARATOR, ""))
    for verb in VERBS:
        said = said.when(F.lower(after).startswith(verb), F.substr(after, F.lit(len(verb) + 1)))
    return F.when(after != "", clean_definition(said))


def aliases(line: Column) -> Column:
    """Other names that a line gives, without bare years, sorted, joined by bars."""
    parts = F.flatten(F.transform(F.regexp_extract_all(line, F.lit(ALIAS), F.lit(1)), lambda x: F.split(x, r"(?U),|\bor\b")))
    named = F.filter(F.transform(parts, lambda x: cut_edges(collapse(x), " .;()")), lambda x: (x != "") & ~x.rlike(rf"\A{YEAR[4:]}\z"))
    return F.array_join(F.array_sort(F.array_distinct(named)), "|")


def years(line: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(line, F.lit(YEAR), F.lit(0)))), "|")


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, each evaluated once a row.

    A plain ``select`` would be folded into every later filter and expression
    that uses the column; a generator of one row is not.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def snippet(c: Column, terms: list[str], size: int = 180, lead: int = 40) -> Column:
    """A stretch of the collapsed text from a little before the earliest term."""
    flat = collapse(text_of(c))
    low = F.lower(flat)
    places = [F.nullif(F.instr(low, t), F.lit(0)) for t in dict.fromkeys(terms)]
    first = F.least(*places, F.lit(None).cast("int")) if places else F.lit(None).cast("int")
    start = F.greatest(F.lit(0), F.coalesce(first, F.lit(1)) - 1 - lead)
    piece = F.trim(F.substr(flat, start + 1, F.lit(size)))
    cut = F.concat(F.when(start > 0, F.lit("...")).otherwise(""), piece, F.when(start + size < F.length(flat), F.lit("...")).otherwise(""))
    return F.when(F.length(flat) <= size, flat).otherwise(cut)


def safe_id_error(field: str, c: Column) -> Column:
    """Why an id cannot name an output; the empty text if it can."""
    unsafe = F.concat(F.lit(f"{field} contains unsafe output path characters: "), c)
    return F.when(is_blank(c), F.lit(f"{field} must not be empty")).when(~c.rlike(SAFE_ID) | c.contains("\n"), unsafe).otherwise("")
