"""Filings' HTML: nodes, table cells with spans, and what stands around tables.

One Python pass turns a document into flat rows; everything after it is DataFrame operations.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import classify as C
from . import windows as W

#: Elements that end an open one of their kind, up to the container named.
_CLOSES = {"td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}), "li": ({"li"}, {"ul", "ol"}), "p": ({"p"}, {"td", "th", "div", "body"}), "option": ({"option"}, {"select"})}
_BLOCKS = {"p", "div", "section", "article", "span", "td", "th", "li", "b", "strong", "caption", "h1", "h2", "h3", "h4", "h5", "h6", "sup", "a"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "col", "area", "base", "embed", "source", "track", "wbr"}


class _Builder(HTMLParser):
    """Elements with their place, and tables with their rows of cells."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []  # tag, attrs, text parts, parent, table
        self.open: list[int] = []
        self.silent = 0
        self.tables: list[dict] = []
        self.inside: list[int] = []  # open tables

    def _close(self, k: int) -> None:
        for i in reversed(self.open[k:]):
            if self.nodes[i]["tag"] == "table" and self.inside:
                self.inside.pop()
            if self.nodes[i]["tag"] in ("script", "style"):
                self.silent -= 1
        del self.open[k:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        kinds, stops = _CLOSES.get(tag, (set(), set()))
        for k in range(len(self.open) - 1, -1, -1):
            name = self.nodes[self.open[k]]["tag"]
            if name in kinds:
                self._close(k)
                break
            if name in stops or not kinds:
                break
        node = {"tag": tag, "attrs": dict(attrs), "text": [], "parent": self.open[-1] if self.open else -1, "table": self.inside[-1] if self.inside else -1}
        self.nodes.append(node)
        at = len(self.nodes) - 1
        if tag == "table":
            self.tables.append({"node": at, "rows": [], "outer": list(self.inside)})
            self.inside.append(len(self.tables) - 1)
        elif tag == "tr":
            for t in self.inside:  # a table's rows include those of tables within it
                self.tables[t]["rows"].append([])
        elif tag in ("td", "th") and self.inside:
            for t in self.inside:
                if self.tables[t]["rows"]:
                    self.tables[t]["rows"][-1].append(at)
        if tag in ("script", "style"):
            self.silent += 1
        if tag not in _VOID:
            self.open.append(at)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[k]]["tag"] == tag:
                self._close(k)
                return

    def handle_data(self, data: str) -> None:
        if not self.silent and data.strip():
            for i in self.open:
                self.nodes[i]["text"].append(data.strip())


def _clean(parts: list[str]) -> str:
    return " ".join(" ".join(parts).split())


def _span(node: dict, name: str) -> int:
    value = (node["attrs"].get(name) or "1").strip()
    return max(1, min(int(value), 1000)) if value.isdigit() else 1


def _expand(rows: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """Cells (text, rowspan, colspan) laid out: a spanning cell's text stands in every place that it covers; blank ends are cut."""
    out, carried = [], {}
    for cells in rows:
        row, below = [], {}

        def place(text: str, left: int) -> None:
            if left > 1:
                below[len(row)] = (text, left - 1)
            row.append(text)

        for text, down, across in cells:
            while len(row) in carried:
                place(*carried.pop(len(row)))
            for _ in range(across):
                place(text, down)
        while len(row) in carried:
            place(*carried.pop(len(row)))
        carried = below
        while row and not row[-1]:
            row.pop()
        out.append(row)
    return out


_NUMERIC = re.compile(r"\d{1,3}(?:,\d{3})*(?:\.\d+)?|\d+(?:\.\d+)?")


def repair(row: list[str]) -> list[str]:
    """A `$` cell joins the number after it; `(`, number, `)` in three cells, or a number and `)` after an open bracket, become one negative."""
    row, k = list(row), 0
    while k < len(row) - 1:
        here, nxt, third = row[k].strip(), row[k + 1].strip(), row[k + 2].strip() if k + 2 < len(row) else ""
        if here == "$" and _NUMERIC.fullmatch(nxt):
            row[k], row[k + 1], k = "", "$" + nxt, k + 2
        elif here == "(" and _NUMERIC.fullmatch(nxt) and third == ")":
            row[k], row[k + 1], row[k + 2], k = "", f"({nxt})", "", k + 3
        elif nxt == ")" and here[:1] == "(" and _NUMERIC.fullmatch(here[1:]):
            row[k], row[k + 1], k = here + ")", "", k + 2
        else:
            k += 1
    return row


def parse(source: str, max_rows: int = 250, references: tuple[str, ...] | None = None) -> tuple[list[dict], list[dict]]:
    """(nodes, table rows) of a document; nodes in document order, rows of each table, nested ones' rows included.

    Of character references only the named ones are decoded, and only with their `;`; all, as browsers do, without names.
    """
    b = _Builder()
    source = source or ""
    if references is not None:
        source = re.sub(rf"&(?!(?:{'|'.join(references)});)", "&amp;", source)
    b.feed(source)
    b.close()
    table_at = {t["node"]: k for k, t in enumerate(b.tables)}
    nodes = [{"pos": i, "tag": n["tag"], "parent": n["parent"], "in_table": n["table"], "is_table": table_at.get(i, -1), "text": _clean(n["text"]), "href": n["attrs"].get("href") or "", "style": n["attrs"].get("style") or ""} for i, n in enumerate(b.nodes)]
    rows = []
    for k, t in enumerate(b.tables):
        laid = _expand([[(_clean(b.nodes[i]["text"]), _span(b.nodes[i], "rowspan"), _span(b.nodes[i], "colspan")) for i in row] for row in t["rows"][:max_rows]])
        rows += [{"table_idx": k, "row_idx": r, "cells": repair(cells), "marks": [_marks(b, i) for i in source_row[:1]][0] if source_row else []} for r, (cells, source_row) in enumerate(zip(laid, t["rows"]))]
    return nodes, rows


def _marks(b: _Builder, cell: int) -> list[str]:
    """Footnote numbers in a label cell: of <sup>, of links and their targets."""
    out = []
    for i in range(cell + 1, len(b.nodes)):
        n, up = b.nodes[i], b.nodes[i]["parent"]
        while up > cell:
            up = b.nodes[up]["parent"]
        if up != cell:
            break
        if n["tag"] == "sup" or n["tag"] == "a" or "footnote" in n["tag"]:
            out += re.findall(r"\d+", _clean(n["text"])) or (re.findall(r"(\d+)\s*$", n["attrs"].get("href") or "") if n["tag"] == "a" else [])
    return list(dict.fromkeys(out))


_NODES = "array<struct<pos:int,tag:string,parent:int,in_table:int,is_table:int,text:string,href:string,style:string>>"
_ROWS = "array<struct<table_idx:int,row_idx:int,cells:array<string>,marks:array<string>>>"


def parsed(documents: DataFrame, *keys: str, max_rows: int = 250, references: tuple[str, ...] | None = None) -> DataFrame:
    """(keys, nodes, rows) of documents(keys, html): the only Python step; each document is parsed once."""
    kept = documents.select(*keys, "html")
    out = kept.select(*keys).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_n = pa.list_(pa.struct([("pos", pa.int32()), ("tag", pa.string()), ("parent", pa.int32()), ("in_table", pa.int32()), ("is_table", pa.int32()), ("text", pa.string()), ("href", pa.string()), ("style", pa.string())]))
        kind_r = pa.list_(pa.struct([("table_idx", pa.int32()), ("row_idx", pa.int32()), ("cells", pa.list_(pa.string())), ("marks", pa.list_(pa.string()))]))
        for batch in batches:
            for k in range(0, batch.num_rows, 16):
                part = batch.slice(k, 16)
                found = [parse(x, max_rows, references) for x in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([f[0] for f in found], kind_n), pa.array([f[1] for f in found], kind_r)], names=[*keys, "nodes", "rows"])

    from pyspark.sql.types import _parse_datatype_string as kind

    return kept.mapInArrow(run, out.add("nodes", kind(_NODES)).add("rows", kind(_ROWS)))


def nodes(pages: DataFrame, *keys: str) -> DataFrame:
    return pages.select(*keys, F.explode("nodes").alias("n")).select(*keys, "n.*")


def grid(pages: DataFrame, *keys: str) -> DataFrame:
    """(keys, table_idx, row_idx, cells, marks)."""
    return pages.select(*keys, F.explode("rows").alias("r")).select(*keys, "r.*")


def plain_text(pages: DataFrame, *keys: str, most: int = 400_000) -> DataFrame:
    """(keys, text): a document's text in one line, its first characters for model stages."""
    whole = F.array_join(F.transform(F.filter("nodes", lambda n: n["parent"] == -1), lambda n: n["text"]), " ")
    return pages.select(*keys, F.left(T.clean(whole), F.lit(most)).alias("text"))


def candidates(pages: DataFrame, *keys: str, preview_rows: int = 15, preview_cols: int = 8) -> DataFrame:
    """One row for each table: size, preview, labels, years, hits, ratios and the text before it."""
    k = [*keys, "table_idx"]
    rows = grid(pages, *keys)
    head = rows.where(F.col("row_idx") < preview_rows).withColumn("cells", F.slice("cells", 1, preview_cols))
    signals = head.select(*k, F.explode("cells").alias("c")).where("c <> ''").groupBy(*k).agg(F.avg(T.looks_numeric(F.col("c")).cast("int")).alias("numeric_cell_ratio"), F.avg(T.looks_money(F.col("c")).cast("int")).alias("money_cell_ratio"), F.max(F.col("c").rlike("[$€£]")).alias("has_currency_symbol"))
    preview = F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "cells"))), lambda r: r["cells"])
    shape = head.groupBy(*k).agg(preview.alias("preview"), F.max(F.size("cells")).alias("n_cols")).join(rows.groupBy(*k).agg(F.count("*").alias("n_rows")), k)
    joined = lambda rows_: F.array_join(F.transform(rows_, lambda r: F.array_join(r, " ")), " ")
    shape = shape.withColumn("header_preview", F.slice("preview", 1, 6)).withColumn("year_header_text", F.trim(joined(F.col("header_preview"))))
    labels = F.filter(F.transform("preview", lambda r: F.trim(F.coalesce(F.get(r, F.lit(0)), F.lit("")))), lambda x: x != "")
    out = shape.withColumn("row_label_preview", F.slice(labels, 1, 20)).join(signals, k, "left").join(context(pages, *keys), k, "left")
    out = out.na.fill("", ["caption_text", "heading_context", "nearby_text_context"]).na.fill(0.0, ["numeric_cell_ratio", "money_cell_ratio"]).na.fill(False, ["has_currency_symbol"])
    combined = F.concat_ws(" ", "caption_text", "heading_context", "nearby_text_context", "year_header_text", joined(F.slice("preview", 1, 5)))
    out = out.withColumn("detected_years", T.years(combined)).withColumn("keyword_hits", T.keyword_hits(combined)).withColumn("units_hint", T.units_hint(combined))
    return out.withColumn("has_units_marker", F.col("units_hint") != "").withColumn("has_year_header", F.size(T.years(F.col("year_header_text"))) >= 2).withColumn("n_keyword_hits", F.size("keyword_hits")).withColumn("n_years", F.size("detected_years")).withColumn("table_id", F.format_string("t%04d", "table_idx"))


def summaries(tables: DataFrame, *keys: str) -> DataFrame:
    """Candidates cut to what a prompt shows: 12 labels, 200 characters of caption and heading, 280 of the text before."""
    short = lambda c, n: F.left(F.coalesce(F.col(c), F.lit("")), F.lit(n)).alias(c)
    return tables.select(*keys, "table_id", "n_rows", "n_cols", F.slice("row_label_preview", 1, 12).alias("row_label_preview"), "detected_years", "keyword_hits", "units_hint", short("caption_text", 200), short("heading_context", 200), short("nearby_text_context", 280))


def context(pages: DataFrame, *keys: str, near: int = 800) -> DataFrame:
    """(keys, table_idx, caption_text, heading_context, nearby_text_context): what precedes each table in the document."""
    all_nodes = nodes(pages, *keys)
    order = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    outside = F.col("in_table") < 0
    title = F.when(outside & F.col("tag").rlike("^h[1-6]$") & (F.col("text") != ""), F.left("text", F.lit(250)))
    bold = F.when(outside & F.col("tag").isin("b", "strong") & F.length("text").between(3, 200), F.col("text"))
    text = F.when(outside & F.col("tag").isin("p", "h1", "h2", "h3", "h4", "h5", "h6", "li") & (F.col("text") != ""), F.col("text"))
    seen = all_nodes.withColumn("h", F.last(title, True).over(order)).withColumn("b", F.last(bold, True).over(order)).withColumn("t", F.collect_list(text).over(Window.partitionBy(*keys).orderBy("pos").rowsBetween(-300, -1)))
    caption = all_nodes.where("tag = 'caption'").groupBy(*keys, F.col("in_table").alias("table_idx")).agg(F.min_by("text", "pos").alias("caption_text"))
    tables = seen.where("is_table >= 0").select(*keys, F.col("is_table").alias("table_idx"), F.coalesce("h", "b", F.lit("")).alias("heading_context"), F.trim(F.array_join(F.array_distinct("t"), " ")).alias("near"))
    tables = tables.select(*keys, "table_idx", "heading_context", F.when(F.length("near") > near, F.substring("near", F.length("near") - near + 1, F.lit(near))).otherwise(F.col("near")).alias("nearby_text_context"))
    out = tables.join(caption, [*keys, "table_idx"], "left").withColumn("caption_text", F.coalesce("caption_text", F.lit("")))
    return out.withColumn("heading_context", F.when(F.col("caption_text") != "", F.left("caption_text", F.lit(250))).otherwise(F.col("heading_context")))


def headings(pages: DataFrame, *keys: str, most: int = 80) -> DataFrame:
    """(keys, place, heading): distinct headings of 5 to 180 characters in order of appearance."""
    some = nodes(pages, *keys).where(F.col("tag").isin("h1", "h2", "h3", "b", "strong") & F.length("text").between(5, 180))
    once = some.groupBy(*keys, F.col("text").alias("heading")).agg(F.min("pos").alias("pos"))
    return W.ranked(once, [F.col("pos")], *keys, most=most).select(*keys, F.col("rank").alias("place"), "heading")


def footnote_ids(pages: DataFrame, *keys: str) -> DataFrame:
    """(keys, table_idx, label, ids) of the rows whose label carries footnote marks."""
    return grid(pages, *keys).where("size(marks) > 0").select(*keys, "table_idx", F.get("cells", F.lit(0)).alias("label"), F.col("marks").alias("ids"))


def around_tables(pages: DataFrame, *keys: str, before: int = 5, after: int = 5) -> DataFrame:
    """(keys, table_idx, kind, place, text): blocks beside each table, nearest first: caption, before, after or footnote."""
    all_nodes = nodes(pages, *keys).where("in_table < 0")
    tables = nodes(pages, *keys).where("is_table >= 0").select(*keys, F.col("is_table").alias("table_idx"), F.col("pos").alias("at"), F.col("parent").alias("up"))
    beside = all_nodes.where(C.is_content(F.col("tag"), F.col("text")) & (F.col("is_table") < 0)).join(tables, list(keys)).where("parent = up AND pos <> at")
    side = F.when(F.col("pos") < F.col("at"), "before").otherwise("after")
    placed = beside.withColumn("side", side).withColumn("place", F.row_number().over(Window.partitionBy(*keys, "table_idx", "side").orderBy(F.abs(F.col("pos") - F.col("at")))))
    kept = placed.where(((F.col("side") == "before") & (F.col("place") <= before)) | ((F.col("side") == "after") & (F.col("place") <= after + 2)))
    kind = F.when((F.col("side") == "after") & T.is_footnote(F.col("text")), "footnote").otherwise(F.col("side"))
    captions = context(pages, *keys).where("caption_text <> ''").select(*keys, "table_idx", F.lit("caption").alias("kind"), F.lit(0).alias("place"), F.col("caption_text").alias("text"))
    return kept.select(*keys, "table_idx", kind.alias("kind"), "place", "text").unionByName(captions)


def under_heading(pages: DataFrame, labels: DataFrame, *keys: str, most: int = 15_000) -> DataFrame:
    """(keys, label, text): what follows a label's own heading, up to a heading of its rank.

    labels(keys, label).  Known subheadings and headings of more than two words go on; one of two words or
    fewer ends the text if 200 characters came before it.
    """
    from ..functions import fixed

    k = list(keys)
    flat = nodes(pages, *k).where("in_table < 0")
    bold = F.col("style").rlike(r"(?i)font-weight\s*:\s*(bold|700)")
    is_head = F.col("tag").isin("b", "strong", "h1", "h2", "h3", "h4") | bold
    marked = flat.withColumn("head", F.when(is_head & (F.length("text") <= 101), F.trim(F.lower("text"))))
    starts = marked.join(labels.select(*k, "label", F.trim(F.lower("label")).alias("head")).distinct(), [*k, "head"]).groupBy(*k, "label").agg(F.min("pos").alias("at"))
    body = flat.where(F.col("tag").isin("p", "div", "li", "span") & (F.col("text") != "")).join(flat.select(*k, F.col("parent").alias("pos")).where("pos >= 0").distinct().withColumn("inner", F.lit(True)), [*k, "pos"], "left")
    leaf = body.where(F.col("inner").isNull() | (F.col("tag") == "p")).select(*k, "pos", "text")
    after = leaf.join(starts, k).where("pos > at")
    so_far = F.sum(F.length("text") + 1).over(Window.partitionBy(*k, "label").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    after = after.withColumn("chars", F.coalesce(so_far, F.lit(0)))
    heads = marked.where("head IS NOT NULL").select(*k, F.col("pos").alias("hpos"), "head").join(starts, k).where("hpos > at")
    chars_at = after.groupBy(*k, "label").agg(F.min(F.when(F.col("chars") > 200, F.col("pos"))).alias("deep"))
    heads = heads.join(chars_at, [*k, "label"], "left").where(F.col("head").isin(*fixed.PEER_HEADINGS) | ((F.size(F.split("head", r"\s+")) <= 2) & ~F.col("head").isin(*fixed.CHILD_HEADINGS) & (F.col("head") != F.trim(F.lower("label"))) & (F.col("hpos") >= F.col("deep"))))
    stop = heads.groupBy(*k, "label").agg(F.min("hpos").alias("stop"))
    kept = after.join(stop, [*k, "label"], "left").where((F.col("stop").isNull() | (F.col("pos") < F.col("stop"))) & (F.col("chars") < most))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), " ")
    return kept.groupBy(*k, "label").agg(T.clean(text).alias("text"))
