"""Column functions over strings, money and small arrays.  All stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed

def let(x: Column, then) -> Column:
    """then(x) with x evaluated once: what a ladder uses many times would otherwise stand in the generated code as often."""
    return F.get(F.transform(F.array(x), then), F.lit(0))


# --- patterns -----------------------------------------------------------------------------------


def any_of(patterns: tuple[str, ...] | str) -> str:
    """One pattern that finds what any of them finds, whatever the case."""
    return "(?i)" + (patterns if isinstance(patterns, str) else "|".join(f"(?:{p})" for p in patterns))


def found(text: Column, patterns: tuple[str, ...] | str) -> Column:
    return text.rlike(any_of(patterns))


def first_hit(text: Column, patterns: tuple[str, ...]) -> Column:
    """The first of the patterns, as listed, that the text holds; null if none."""
    return F.get(F.filter(F.array(*[F.lit(p) for p in patterns]), lambda p: F.regexp_like(text, F.concat(F.lit("(?i)"), p))), F.lit(0))


def hits(text: Column, patterns: tuple[str, ...]) -> Column:
    """How many of the patterns the text holds."""
    return reduce(lambda a, b: a + b, [found(text, (p,)).cast("int") for p in patterns])


def contained(text: Column, words: tuple[str, ...]) -> Column:
    """How many of the words the text contains."""
    return reduce(lambda a, b: a + b, [F.contains(text, F.lit(w)).cast("int") for w in words])


# --- cleaning -----------------------------------------------------------------------------------


def clean(x: Column) -> Column:
    """Runs of Unicode white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def clean_line(label: Column) -> Column:
    """Without a footnote number at the end."""
    return F.trim(F.regexp_replace(label, r"\s*\(\d+\)\s*$", ""))


def clean_segment(name: Column) -> Column:
    """Without a parenthesis at the end, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(name, r"\s*\([^)]*\)\s*$", ""), r"\s+", " "))


def file_name(x: Column) -> Column:
    return F.regexp_replace(x, r"[^A-Za-z0-9._-]+", "_")


def sheet_name(x: Column) -> Column:
    """At most 31 characters, none of []:*?/\\, not blank."""
    safe = F.translate(x, "[]:*?/\\", "_______")
    return F.left(F.when(F.trim(safe) == "", F.lit("Sheet")).otherwise(safe), F.lit(31))


def without_page_noise(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(x, "(?im)" + "|".join(fixed.PAGE_NOISE), " "), r"\s{2,}", " "))


def sentences(x: Column) -> Column:
    return F.split(x, r"(?<=[.!?])\s+(?=[A-Z])")


def without_accounting(x: Column) -> Column:
    """Without page noise, and without sentences about accounting or about how a business performed."""
    deny = any_of(fixed.ACCOUNTING_DENY)
    kept = F.filter(sentences(without_page_noise(x)), lambda s: ~s.rlike(deny))
    return F.trim(F.array_join(kept, " "))


def is_table_header(x: Column) -> Column:
    """Whether a text is the head of a table rather than a definition."""
    low = F.lower(x)
    return (
        (contained(low, tuple(m.lower() for m in fixed.HEADER_MARKERS)) >= 2)
        | x.rlike(r"\b20\d{2}\s+20\d{2}\s+20\d{2}\b")
        | x.rlike(r"^\s*\$?\s*\d{1,3}(?:,\d{3})+")
        | F.left(x, F.lit(200)).rlike(r"(?i)\b\d+\s*%\s*(change|increase|decrease)\b")
    )


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column whose costly expression is evaluated once a row: a generator's output isn't copied into the filters and columns that use it."""
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


# --- money and units ----------------------------------------------------------------------------

_DASHES = ("", "-", "—", "–", "$", "−")


def _number(digits: Column, negative: Column) -> Column:
    ok = digits.rlike(r"^(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$")
    value = F.when(ok, F.bround(digits.try_cast("double"), 0).try_cast("bigint"))
    return F.when(negative, -value).otherwise(value)


def _signed(trimmed: Column, nothing: tuple[str, ...], drop: str, minus: str) -> Column:
    """A trimmed amount without its brackets or sign as a number; null for the marks that mean nothing."""
    paren = lambda t: t.rlike(r"(?s)^\(.*\)$")
    bare = lambda t: F.trim(F.regexp_replace(F.when(paren(t), F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t), drop, ""))
    value = lambda t: let(bare(t), lambda d: let(d.rlike(minus), lambda m: _number(F.when(m, F.substring(d, F.lit(2), F.length(d))).otherwise(d), paren(t) | m)))
    return let(trimmed, lambda t: F.when(~t.isin(*nothing), value(t)))


def money(x: Column) -> Column:
    """'$1,234', '(500)', '−3' as whole numbers, halves to even; null for dashes and whatever isn't a number."""
    return _signed(F.regexp_replace(x, r"(?U)^\s+|\s+$", ""), _DASHES, r"[$, ]", "^[-−]")


def number(x: Column) -> Column:
    """The lenient kin of money(): inner spaces are kept, so '1 2' is no number."""
    return _signed(F.trim(x), ("", "-", "—", "–"), r"[$,]", "^-")


def money_near(row: Column, col: Column) -> Column:
    """The first number in a cell or the two after it."""
    return F.coalesce(*[money(F.get(row, (col + k).cast("int"))) for k in range(3)])


def units(x: Column) -> Column:
    low = F.lower(x)
    return F.when(F.contains(low, F.lit("billion")), 1_000_000_000).when(F.contains(low, F.lit("million")), 1_000_000).when(F.contains(low, F.lit("thousand")), 1_000).otherwise(1).cast("bigint")


def statement_units(x: Column) -> Column:
    """Units of an income statement: millions unless only thousands, or only billions, are named."""
    low = F.lower(x)
    return F.when(F.contains(low, F.lit("in millions")), 1_000_000).when(F.contains(low, F.lit("in thousands")), 1_000).when(F.contains(low, F.lit("in billions")), 1_000_000_000).otherwise(1_000_000).cast("bigint")


def units_hint(x: Column) -> Column:
    """'(in millions)' as it stands, else the bare phrase, else ''."""
    low, bracket = F.lower(x), F.regexp_extract(x, r"(?i)\(\s*in\s+(millions|billions|thousands)\s*\)", 0)
    bare = F.coalesce(*[F.when(F.contains(low, F.lit(f"in {u}")), F.lit(f"in {u}")) for u in ("millions", "billions", "thousands")], F.lit(""))
    return F.when(bracket != "", bracket).otherwise(bare)


def in_millions(v: Column) -> Column:
    return F.bround(v.cast("decimal(20,0)") / 1_000_000, 2).cast("double")


def years(x: Column) -> Column:
    """Distinct years from 1990 to 2100, ascending."""
    got = F.transform(F.regexp_extract_all(x, F.lit(r"\b((?:19|20)\d{2})\b"), F.lit(1)), lambda y: y.cast("int"))
    return F.array_sort(F.array_distinct(F.filter(got, lambda y: y.between(1990, 2100))))


def header_year(cell: Column, low: int = 2018, high: int = 2030) -> Column:
    """The first year of a header cell if it is in the range."""
    y = F.nullif(F.regexp_extract(cell, r"\b(20\d{2})\b", 1), F.lit("")).cast("int")  # a failed try_cast costs an exception in each cell
    return F.when(y.between(low, high), y)


def looks_numeric(x: Column) -> Column:
    t = F.trim(x)
    return t.rlike(r"^\(?\s*[-+]?\d+(?:\.\d+)?\s*%?\s*\)?$") | looks_money(x)


def looks_money(x: Column) -> Column:
    return F.trim(x).rlike(r"^\(?\$?\s*[-+]?\d{1,3}(?:,\d{3})*(?:\.\d+)?\)?$|^\(?\$?\s*[-+]?\d+(?:\.\d+)?\)?$")


def is_amount_label(x: Column) -> Column:
    return F.trim(x).rlike(r"^[\s$€£¥(),.0-9\-]+$")


# --- words --------------------------------------------------------------------------------------


def keyword_hits(x: Column, words: tuple[str, ...] = fixed.KEYWORDS) -> Column:
    low = F.lower(x)
    return F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w))


def tokens(label: Column) -> Column:
    """Distinct words of a label for fuzzy matching: no trailing parenthesis, no stop words, two letters at least."""
    s = F.regexp_replace(F.trim(label), r"\s*\([^)]*\)\s*$", "")
    s = F.trim(F.regexp_replace(F.lower(F.regexp_replace(s, r"[,/\-–—&]+", " ")), r"\s+", " "))
    return F.array_distinct(F.filter(F.split(s, " "), lambda t: (F.length(t) > 1) & ~t.isin(*fixed.STOPWORDS)))


def overlap(a: Column, b: Column) -> Column:
    """Shared words over the smaller set's; 0 if either is empty."""
    small = F.least(F.size(a), F.size(b))
    return F.when(small > 0, F.size(F.array_intersect(a, b)) / small).otherwise(F.lit(0.0))


def jaccard_of_beginnings(a: Column, b: Column, chars: int = 150) -> Column:
    x, y = beginning(a, chars), beginning(b, chars)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))).otherwise(F.lit(0.0))


def beginning(text: Column, chars: int = 150) -> Column:
    """The distinct lower-case words of the first characters."""
    return F.array_distinct(F.filter(F.split(F.lower(F.left(text, F.lit(chars))), r"\s+"), lambda w: w != ""))


def search_terms(label: Column) -> Column:
    """The label, the expansions of what it contains or is contained in, and its words of three letters or more."""
    low = F.trim(F.lower(label))
    more = [F.when(F.contains(low, F.lit(k)) | F.contains(F.lit(k), low), F.array(*[F.lit(e) for e in v])).otherwise(F.array().cast("array<string>")) for k, v in fixed.LABEL_EXPANSIONS.items()]
    words = F.filter(F.transform(F.regexp_extract_all(label, F.lit(r"\b([a-zA-Z]{3,})\b"), F.lit(1)), F.lower), lambda w: ~w.isin("the", "and", "for", "from", "other"))
    return F.array_distinct(F.concat(F.array(F.lower(label)), *more, words))


# --- structure ----------------------------------------------------------------------------------


def section(text: Column, pattern: str, most: int = 50_000) -> Column:
    """From the first match to the next `item n` more than 500 characters on, `most` characters at most; '' without a match."""
    start = F.regexp_instr(text, F.lit(pattern))
    tail = F.substring(text, start + 501, F.length(text))
    stop = F.regexp_instr(tail, F.lit(r"(?i)\bitem\s+\d+"))
    length = F.when(stop > 0, F.least(stop + 500, F.lit(most))).otherwise(F.lit(most))
    return F.when(start > 0, F.substring(text, start, length)).otherwise(F.lit(""))


def note2(text: Column, most: int = 50_000) -> Column:
    """The revenue note: from `Note 2 … Revenue` to `Note 3` or `Note 4`; null without one."""
    start = F.regexp_instr(text, F.lit(r"(?i)Note\s*2[^A-Za-z]*Revenue"))
    stop = F.regexp_instr(F.substring(text, start + 100, F.length(text)), F.lit(r"(?i)Note\s*[34]"))
    return F.when(start > 0, F.substring(text, start, F.when(stop > 0, F.least(stop + 99, F.lit(most))).otherwise(F.lit(most))))


def heading(text: Column) -> Column:
    """A chunk's heading: its first line in capitals, or a first line of one to six capitalised words; null otherwise."""
    line = F.trim(F.get(F.split(F.trim(text), "\n"), F.lit(0)))
    capitals = (F.length(line) > 0) & (F.length(line) < 100) & (F.upper(line) == line) & line.rlike("[A-Za-z]")
    return F.when(capitals | line.rlike(r"^[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,5}$"), line)


def is_footnote(text: Column) -> Column:
    head = F.left(text, F.lit(200))
    return text.rlike(r"^\s*[\(\[]?\d+[\)\]]?\s+[A-Z]") | head.rlike("[¹²³⁴⁵⁶⁷⁸⁹⁰]")


def table_index(table_id: Column) -> Column:
    return F.substring(table_id, F.lit(2), F.length(table_id)).try_cast("int")


def json_body(reply: Column) -> Column:
    """A model's reply without code fences, from its first { to its last }."""
    bare = F.regexp_replace(F.trim(reply), r"^```(?:json)?\s*|\s*```$", "")
    a = F.locate("{", bare)
    b = F.length(bare) - F.locate("}", F.reverse(bare)) + 1
    return F.when((a > 0) & (F.locate("}", bare) > 0) & (b >= a), F.substring(bare, a, b - a + 1)).otherwise(bare)


def retry_seconds(message: Column) -> Column:
    return F.regexp_extract(message, r"(?i)try again in\s+(\d+(?:\.\d+)?)\s*s", 1).try_cast("double")


def retrieval_query(company: Column, ticker: Column, year: Column, line: Column, group: Column, caption: Column) -> Column:
    """The query for a revenue line; a null or empty group or caption leaves its part out."""
    part = lambda before, x, after: F.when(F.coalesce(x, F.lit("")) != "", F.concat(F.lit(before), x, F.lit(after)))
    return F.concat_ws(
        " ", F.concat(company, F.lit(" ("), ticker, F.lit(")")), F.concat(F.lit("FY"), year.cast("string")), F.concat(F.lit("revenue line '"), line, F.lit("'")), part("in segment '", group, "'"), part("Table: ", caption, ""),
        F.concat(F.lit('"'), line, F.lit(' consists of" "'), line, F.lit(' includes"')), F.lit("products and services offerings generated from"),
    )
