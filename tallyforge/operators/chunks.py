"""Text positions, contents regions, sections and overlapping chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, text as T
from . import classify as C
from . import windows as W


def _positions(patterns: dict[str, str], flags: int):
    compiled = {k: re.compile(p, flags) for k, p in patterns.items()}

    @F.pandas_udf("array<struct<name:string,start:int,end:int>>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"name": k, "start": m.start(), "end": m.end()} for k, p in compiled.items() for m in p.finditer(t or "")])

    return run


def positions(documents: DataFrame, patterns: dict[str, str], *keys: str, flags: int = re.IGNORECASE) -> DataFrame:
    """(keys, name, start, end, length) of every match of named patterns: offsets, which SQL has no function for."""
    rows = documents.withColumn("_m", _positions(patterns, flags)(F.col("text"))).select(*keys, F.explode("_m").alias("m"), F.length("text").alias("length"))
    return rows.select(*keys, "m.*", "length")


#: Patterns of contents regions, and of where a section may end.
_CONTENTS = {"item": r"Item\s+\d+[A-Z]?\s*[\.\s]{2,}", "head": r"TABLE\s+OF\s+CONTENTS", "next": r"\n\s*(PART\s+I[^V]|ITEM\s+1[^0-9A-Z])"}
_STOP = {"stop": r"\n\s*(ITEM\s+\d+[A-Z]?|NOTE\s+\d+\s*[-–—])"}


def contents_regions(documents: DataFrame, *keys: str) -> DataFrame:
    """(keys, start, end): five `Item n` within 2000 characters, 500 wider, and the block from TABLE OF CONTENTS to the first part or item.

    Texts are read once for all patterns; what follows works on the matches.
    """
    at = positions(documents, _CONTENTS, *keys)
    name, near = F.col("name"), Window.partitionBy(*keys)
    at = at.withColumn("_dense", F.when(name == "item", W.run_end(5, 2000, *keys, "name"))).withColumn("_head", F.min(F.when(name == "head", F.struct("start", "end"))).over(near))
    stop = F.min(F.when((name == "next") & (F.col("start") >= F.col("_head.end")), F.col("start"))).over(near)
    at = at.withColumn("_next", F.when((name == "head") & (F.col("start") == F.col("_head.start")), stop))
    start = F.when(F.col("_dense").isNotNull(), F.greatest(F.col("start") - 500, F.lit(0))).otherwise(F.col("start"))
    end = F.coalesce(F.least(F.col("_dense") + 500, F.when(F.col("_dense").isNotNull(), F.col("length"))), F.col("_next"))
    return W.merge_intervals(at.select(*keys, start.alias("start"), end.alias("end")).where("end IS NOT NULL"), *keys)


def sections(documents: DataFrame, regions: DataFrame, *keys: str) -> DataFrame:
    """(keys, section, start, end): each section's first heading outside contents that prose follows, to the next ITEM or NOTE heading.  Texts are read once."""
    k = list(keys)
    span = "array<struct<start:int,end:int>>"
    held = regions.groupBy(*k).agg(F.collect_list(F.struct("start", "end")).alias("_r"))
    rows = documents.select(*k, "text", _positions({**fixed.CHUNK_SECTIONS, **_STOP}, re.IGNORECASE)(F.col("text")).alias("_m")).join(held, k, "left")
    inside = lambda m: F.exists(F.coalesce("_r", F.array().cast(span)), lambda r: (m["start"] >= r["start"]) & (m["start"] < r["end"]))
    rows = rows.withColumn("_m", F.filter("_m", lambda m: ~inside(m)))
    is_stop = lambda m: m["name"] == "stop"
    heads = F.filter("_m", lambda m: ~is_stop(m) & C.has_body_density(F.substring(F.col("text"), m["start"] + 1, F.lit(2000))))
    stops = F.transform(F.filter("_m", is_stop), lambda m: m["start"])
    found = rows.select(*k, F.length("text").alias("length"), stops.alias("_stops"), F.explode(heads).alias("m"))
    first = found.groupBy(*k, F.col("m.name").alias("section")).agg(F.min_by(F.struct("length", "_stops", F.col("m.start").alias("start")), "m.start").alias("f"))
    stop = F.array_min(F.filter("f._stops", lambda s: s >= F.col("f.start") + 500))
    return first.select(*k, "section", "f.start", F.coalesce(stop, "f.length").alias("end"))


def cut(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """[start, end) of each chunk: `size` characters, or up to the last period beyond half of them; the next starts `overlap` earlier."""
    out, at, n = [], 0, len(text)
    while at < n:
        end = min(at + size, n)
        if end < n:
            stop = text.rfind(".", at + size // 2 + 1, end)
            if stop >= 0:
                end = stop + 1
        out.append((at, end))
        at = end - overlap
        if at >= n - overlap:
            break
    return out


def chunks(documents: DataFrame, *keys: str, size: int = 800, overlap: int = 100) -> DataFrame:
    """(keys, chunk_idx, start, end, text) of whole texts; null and empty texts have none."""
    kind = "array<struct<start:int,end:int>>"

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"start": a, "end": b} for a, b in cut(t or "", size, overlap)])

    rows = documents.withColumn("_c", run(F.col("text"))).select(*keys, "text", F.posexplode("_c").alias("chunk_idx", "c"))
    return rows.select(*keys, "chunk_idx", "c.start", "c.end", F.substring("text", F.col("c.start") + 1, F.col("c.end") - F.col("c.start")).alias("raw")).withColumn("text", F.trim(F.regexp_replace("raw", r"^\s+|\s+$", ""))).drop("raw")


def labelled(pieces: DataFrame, spans: DataFrame, regions: DataFrame, *keys: str) -> DataFrame:
    """Chunks with section, heading and is_toc; a chunk has the section that starts last before it, and a revenue note's its kind."""
    k = list(keys)
    of = spans.groupBy(*k).agg(F.collect_list(F.struct("start", "end", "section")).alias("_s"))
    toc = regions.groupBy(*k).agg(F.collect_list(F.struct("start", "end")).alias("_r"))
    rows = pieces.join(of, k, "left").join(toc, k, "left")
    within = F.filter(F.coalesce("_s", F.array().cast("array<struct<start:int,end:int,section:string>>")), lambda s: (F.col("start") >= s["start"]) & (F.col("start") < s["end"]))
    name = F.coalesce(F.array_max(within)["section"], F.lit("other"))
    rows = rows.withColumn("section", F.when(name == "note_revenue", C.note_kind(F.col("text"))).otherwise(name))
    no_regions = F.array().cast("array<struct<start:int,end:int>>")
    return rows.withColumn("is_toc", C.is_contents_chunk(F.col("text"), F.col("start"), F.coalesce("_r", no_regions))).withColumn("heading", T.heading(F.col("text"))).drop("_s", "_r")


def structured(documents: DataFrame, *keys: str) -> DataFrame:
    """A filing's chunks with sections, headings and contents flags."""
    regions = contents_regions(documents, *keys)
    return labelled(chunks(documents, *keys), sections(documents, regions, *keys), regions, *keys).withColumn("chunk_id", F.format_string("chunk_%04d", "chunk_idx"))


def keyword_windows(documents: DataFrame, words: tuple[str, ...], *keys: str, width: int = 1200, most: int = 12) -> DataFrame:
    """(keys, place, snippet): for each word in turn and each place, the text from a third of width before to width after; distinct, the first `most`."""
    k = list(keys)
    at = positions(documents, {w: re.escape(w) for w in words}, *k)
    order = F.array_position(F.array(*[F.lit(w) for w in words]), F.col("name"))
    start = F.greatest(F.col("start") - width // 3, F.lit(0))
    cuts = at.withColumn("_w", order).join(documents.select(*k, "text"), k)
    cuts = cuts.select(*k, "_w", "start", F.trim(F.substring("text", start + 1, F.col("start") + width - start)).alias("snippet")).where("snippet <> ''")
    once = cuts.groupBy(*k, "snippet").agg(F.min(F.struct("_w", "start")).alias("o"))
    return W.ranked(once, [F.col("o")], *k, most=most).select(*k, F.col("rank").alias("place"), "snippet")
