"""Descriptions of revenue lines: a cascade of extractors, each a column; the first that finds one wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text as T


def _quoted(label: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(F.trim(label), F.lit(r"\E"), F.lit("")), F.lit(r"\E"))


def _clean_definition(found: Column) -> Column:
    """Null for nothing, a table's head, or accounting only."""
    return T.let(found, lambda x: T.let(F.when((x != "") & ~T.is_table_header(x), T.without_accounting(F.trim(x))), lambda y: F.nullif(y, F.lit(""))))


def _extract(text: Column, pattern: Column) -> Column:
    """The first group of a pattern that is a column."""
    return F.call_function("regexp_extract", text, pattern, F.lit(1))


def footnote_number(label: Column) -> Column:
    return F.nullif(F.regexp_extract(label, r"\((\d+)\)\s*$", 1), F.lit(""))


def footnotes(text: Column, strict: bool = True) -> Column:
    """map(number, definition) of notes 1 to 9: `(n) Includes …`, else another verb, else (not strict) a capital; 600 characters at most."""

    def one(n: Column) -> Column:
        def take(lead: str, least: int, more=None) -> Column:
            pattern = F.concat(F.lit(r"(?is)\("), n.cast("string"), F.lit(rf"\)\s*({lead}[^(]*?)(?=\(\d+\)|_____|$)"))
            if lead == "[A-Z]":
                pattern = F.replace(pattern, F.lit("(?is)"), F.lit("(?s)"))
            found = F.transform(F.regexp_extract_all(text, pattern, F.lit(1)), T.clean)
            return F.get(F.filter(found, lambda x: (F.length(x) >= least) & (more(x) if more else F.lit(True))), F.lit(0))

        ways = [take(r"Includes\s+", 20), take(r"(?:Represents|Consists|Comprises|Contains)\s+", 20)]
        if not strict:
            ways.append(take("[A-Z]", 30, lambda x: F.regexp_count(x, F.lit(r"\$")) <= 1))
        return F.struct(n.cast("string").alias("key"), F.left(F.coalesce(*ways), F.lit(600)).alias("value"))

    found = F.filter(F.transform(F.sequence(F.lit(1), F.lit(9)), one), lambda x: x["value"].isNotNull())
    return F.map_from_entries(F.coalesce(found, F.expr("cast(array() as array<struct<key:string,value:string>>)")))


def footnote_for(label: Column, document: Column, around_table: Column) -> Column:
    """The note that a label's number names: after the rule below the label, else near the label, else around the table, else in the notes; null without a number."""
    n, name = footnote_number(label), F.trim(F.lower(F.regexp_replace(label, r"\(\d+\)\s*$", "")))
    pattern = F.concat(F.lit(r"(?is)\("), n, F.lit(r"\)\s*(Includes\s+[^(]+?)(?=\(\d+\)|_____|$)"))
    at = F.locate(name, F.lower(document)) if isinstance(name, str) else F.position(name, F.lower(document))
    near = F.when(at > 0, F.substring(document, at, F.lit(15_000)))
    rule = F.position(F.lit("_____"), F.left(near, F.lit(3_000)))
    below = F.when(rule > 0, F.substring(near, rule, F.lit(10_000)))
    note8 = F.regexp_instr(document, F.lit(r"(?i)\bitem\s*8\b"))
    rest = F.when(note8 > 0, F.substring(document, note8, F.lit(200_000)))
    in_notes = F.regexp_extract(rest, r"(?s)(_____+\s*\(\d+\).{0,10000})", 1)
    take = lambda x: T.let(T.clean(_extract(x, pattern)), lambda y: F.when(F.length(y) >= 20, F.left(y, F.lit(600))))
    return F.when(n.isNotNull(), F.coalesce(take(below), take(near), footnotes(around_table)[n], take(in_notes)))


def note_definition(label: Column, document: Column) -> Column:
    """A definition in prose: `label revenue consists of …`; advertising, other revenue and some segments have forms of their own."""
    low, name = F.trim(F.lower(label)), _quoted(label)
    where = F.coalesce(T.note2(document), document)
    lit = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    clean = lambda text, pattern, lead="": _clean_definition(T.let(_extract(text, pattern), lambda x: F.when(x != "", F.concat(F.lit(lead), x)).otherwise(F.lit(""))))
    ads = F.coalesce(
        clean(document, F.lit(r"(?is)(?:substantially all|majority)\s+of\s+(?:our\s+)?revenue\s+from\s+(?:selling\s+)?advertising\s+([^.]{30,400}\.(?:\s+[A-Z][^.]{20,200}\.)?)"), "Revenue from selling advertising "),
        clean(document, F.lit(r"(?is)revenue\s+from\s+marketers\s+advertising\s+on\s+([^.]{20,300}\.)"), "Revenue from marketers advertising on "),
    )
    verbs = r"(?:is generated from|includes|consists of|is comprised of|is derived from|represents|are generated from)"
    direct = clean(where, lit("(?is)", name, rf"(?:\s+(?:revenue|revenues|segment))?\s+{verbs}\s+([^.]{{20,500}}\.)"))
    other = F.when(low.isin("other", "other revenue"), clean(where, F.lit(r"(?is)Other\s+(?:revenue|revenues)\s+(?:consists of|includes|is comprised of|represents)\s+([^.]{20,500}\.)")))
    segment = F.when(low.isin("reality labs", "rl", "family of apps", "foa"), clean(where, lit("(?is)", name, r"[^.]*?(?:revenue|revenues)\s+(?:is generated from|includes|consists of|are generated from)\s+([^.]{20,500}\.)")))
    of = clean(where, lit(r"(?is)revenue\s+from\s+", name, r"\s+(?:includes|consists of|is comprised of|represents)\s+([^.]{20,500}\.)"))
    return F.when(low.isin("advertising", "advertising revenue"), ads).otherwise(F.coalesce(direct, other, segment, of))


def enumeration_definition(line: Column, group: Column, document: Column) -> Column:
    """From `{group} includes a; b; c`: the item that names the line; two lines have richer forms of their own."""
    g, low = F.trim(group), F.trim(F.lower(line))
    joined = F.regexp_replace(F.regexp_replace(g, r"\s*&\s*", "And"), r"\s+", "")
    tail = F.lit(r"\s*(?:segment\s+)?includes?\s+(?:our\s+)?([^.]{50,600})")
    found = F.coalesce(*[F.nullif(_extract(document, F.concat(F.lit("(?is)"), _quoted(x), tail)), F.lit("")) for x in (g, F.replace(g, F.lit("&"), F.lit("&amp;")), joined)])
    items = F.filter(F.transform(F.split(found, ";"), F.trim), lambda x: x != "")
    offers = lambda w: F.nullif(F.regexp_extract(document, rf"(?i)(?:our\s+)?{w}\s+offerings?\s+includes?\s+([^.]{{30,400}}\.)", 1), F.lit(""))
    lead = F.regexp_replace(F.get(items, F.lit(0)), r"(?i)\s+and\s*$", "")
    compute = F.coalesce(F.concat(F.lit("Our compute offerings include "), F.trim(offers("compute"))), F.when(F.length(lead) >= 20, lead))
    network = F.coalesce(F.concat(F.lit("Our networking offerings include "), F.trim(offers("networking"))), F.get(F.filter(items, lambda x: F.contains(F.lower(x), F.lit("network")) & ~F.contains(F.lower(x), F.lit("compute")) & (F.length(x) > 30)), F.lit(0)))
    named = F.get(F.filter(items, lambda x: F.contains(F.lower(x), low)), F.lit(0))
    best = F.coalesce(F.when(low == "compute", compute), F.when(low == "networking", network), named)
    usable = found.isNotNull() & (low != "") & (g != "") & ~F.lower(g).isin("product/service disclosure", "other", "total")
    return F.when(usable, F.nullif(T.without_accounting(best), F.lit("")))


def heading_definition(text: Column) -> Column:
    """What stands under a heading, without accounting: 50 characters at least, six sentences and 1500 characters at most."""
    short = lambda x: F.left(F.array_join(F.slice(T.sentences(x), 1, 6), " "), F.lit(1500))
    return T.let(T.without_accounting(T.clean(text)), lambda x: F.when((F.length(x) >= 50) & ~T.is_table_header(x), short(x)))


def offerings(label: Column, document: Column) -> Column:
    """`Our {label} offerings include …`."""
    found = _extract(document, F.concat(F.lit(r"(?is)(?:our\s+)?"), _quoted(label), F.lit(r"\s+offerings?\s+(?:include|consist\s+of)s?\s+([^.]{30,400}\.)")))
    return F.when(found != "", _clean_definition(found))


def cascade(lines: DataFrame) -> DataFrame:
    """lines(line, group, document, around_table, heading_text, dom_footnote, model_text) with description and source.

    Columns that a caller lacks may be null.  Provenance is kept for every source.
    """
    line, doc = F.col("line"), F.col("document")
    plain = T.clean_line(line)
    ways = (
        ("table_footnote_dom", F.nullif(F.col("dom_footnote"), F.lit(""))),
        ("table_footnote_regex", footnote_for(line, doc, F.col("around_table"))),
        ("heading_based_item1", heading_definition(F.col("heading_text"))),
        ("offerings_pattern", offerings(plain, doc)),
        ("note2_paragraph", note_definition(plain, doc)),
        ("llm_section_search", F.nullif(T.without_accounting(F.col("model_text")), F.lit(""))),
        ("segment_enumeration", enumeration_definition(plain, F.col("group"), doc)),
    )
    out = lines
    for k, (_, way) in enumerate(ways):
        out = out.withColumn(f"_w{k}", way)
    found = [F.col(f"_w{k}") for k in range(len(ways))]
    source = F.coalesce(*[F.when(c.isNotNull(), F.lit(name)) for c, (name, _) in zip(found, ways)])
    return out.withColumn("description", F.coalesce(*found, F.lit(""))).withColumn("source", F.coalesce(source, F.lit(""))).drop(*[f"_w{k}" for k in range(len(ways))])


def products(text: Column) -> Column:
    """Names that look like products: phrases, words, acronyms, marks, models, camel case, quotes and lists after `including` or `such as`."""
    take = lambda p, g=1: F.regexp_extract_all(text, F.lit(p), F.lit(g))
    listed = lambda lead: F.flatten(F.transform(take(rf"(?i){lead}\s+([A-Z][^,\.]{{2,40}}(?:,\s*[A-Z][^,\.]{{2,40}})*)"), lambda m: F.transform(F.split(m, r",\s*(?:and\s+)?"), F.trim)))
    marks = F.transform(take(r"(\b\w+[®™])"), lambda m: F.regexp_replace(m, "[®™]+$", ""))
    every = F.concat(
        take(r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3})\b"), take(r"\b([A-Z][a-z]{3,})\b"), take(r"\b([A-Z]{2,6})\b"), marks, take(r"\b([A-Z]{1,4}\d{2,4}[A-Z]?)\b"),
        take(r"\b([A-Z]?[a-z]+[A-Z][a-z]+(?:[A-Z][a-z]+)?)\b"), take(r'"([^"]{3,30})"'), listed("includ(?:es?|ing)"), listed(r"such\s+as"),
    )
    return F.array_sort(F.filter(F.array_except(every, F.array(*[F.lit(w) for w in fixed.PRODUCT_STOPWORDS])), lambda x: F.length(x) > 2))


def accepted_items(items: DataFrame, *keys: str) -> DataFrame:
    """Key items that their evidence bears out, each once over all segments; items(keys, segment, pos, item, span, text).

    The text holds the item, and the span, or 85 % of its words of more than three letters where it has four, or the span holds the item.
    """
    low = lambda c: F.lower(F.col(c))
    words = F.filter(F.split(low("span"), r"\W+"), lambda w: F.length(w) > 3)
    share = F.size(F.filter(words, lambda w: F.contains(low("text"), w))) / F.greatest(F.size(words), F.lit(1))
    ok = F.contains(low("text"), low("item")) & (F.contains(low("text"), low("span")) | ((F.size(words) >= 4) & (share >= 0.85)) | F.contains(low("span"), low("item")))
    rest = [c for c in items.columns if c not in keys]
    once = items.where(ok).groupBy(*keys, F.regexp_replace(low("item"), r"[\s\-]", "").alias("_k")).agg(F.min_by(F.struct(*rest), F.struct("pos")).alias("_r"))
    return once.select(*keys, "_r.*")
