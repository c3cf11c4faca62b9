"""Stages that a language model may answer, as replaceable parts: recorded replies, or rules that need none."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import classify as C
from ..operators import extract as X
from ..operators import html as H
from ..operators import joins as J
from ..operators import windows as W
from ..sources.filings import Limiter


class ModelClient(Protocol):
    """Answers prompts(prompt) with reply, a JSON text; null where it has none."""

    def answer(self, prompts: DataFrame, stage: str) -> DataFrame: ...


def prompt_key(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


class ReplayClient:
    """Recorded replies (prompt_sha, stage, reply), joined by the prompt's hash."""

    def __init__(self, replies: DataFrame):
        self.replies = replies

    def answer(self, prompts: DataFrame, stage: str) -> DataFrame:
        known = self.replies.where(F.col("stage") == stage).groupBy("prompt_sha").agg(F.max("reply").alias("reply"))
        return prompts.withColumn("prompt_sha", prompt_key(F.col("prompt"))).join(known, "prompt_sha", "left").withColumn("reply", T.json_body(F.col("reply")))


class HttpClient:
    """A chat service that answers in JSON: `rpm` requests a minute, three tries, waits as a 429 asks, one repair call.

    post(url, body, headers) gives (status, text).  Prompts are dealt to `tasks` tasks, each of which keeps to its share
    of the service's limit, so the limit holds for all; what makes the prompts runs in tasks of its own.
    """

    def __init__(self, url: str, model: str, key: str, post: Callable[[str, bytes, dict], tuple[int, str]], rpm: int = 60, tries: int = 3, tasks: int = 4):
        self.url, self.model, self.key, self.post, self.rpm, self.tries, self.tasks = url, model, key, post, rpm, tries, tasks

    def ask(self, prompt: str, sleep: Callable[[float], None]) -> str | None:
        body = {"model": self.model, "response_format": {"type": "json_object"}, "messages": [{"role": "user", "content": prompt}]}
        headers = {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"}
        for attempt in range(self.tries):
            status, text = self.post(self.url, json.dumps(body).encode(), headers)
            if status == 200:
                return json.loads(text)["choices"][0]["message"]["content"]
            hint = re.search(r"try again in\s+(\d+(?:\.\d+)?)\s*s", text, re.I) if status == 429 else None
            if status != 429 and status < 500:
                break
            sleep(float(hint[1]) if hint else 2.0**attempt)
        return None

    def answer(self, prompts: DataFrame, stage: str) -> DataFrame:
        own, out = self, prompts.schema.add("reply", "string")

        def body_of(text: str | None) -> str | None:
            a, b = (text or "").find("{"), (text or "").rfind("}")
            try:
                return json.dumps(json.loads(text[a : b + 1])) if text and 0 <= a < b else None
            except ValueError:
                return None

        def run(frames: Iterator) -> Iterator:
            limiter = Limiter(60 * own.tasks / own.rpm)
            for pdf in frames:
                replies = []
                for prompt in pdf["prompt"]:
                    limiter.wait()
                    text = own.ask(prompt, time.sleep)
                    good = body_of(text)
                    if text and good is None:
                        limiter.wait()
                        good = body_of(own.ask("Give this as valid JSON only:\n" + text, time.sleep))
                    replies.append(good)
                yield pdf.assign(reply=replies)

        return prompts.repartition(self.tasks).mapInPandas(run, out)


def embed(texts: DataFrame, dims: int = 64) -> DataFrame:
    """texts(…, text) with a deterministic vector `v` of hashed words, for use without an embedding service."""
    words = F.filter(F.split(F.lower("text"), r"\W+"), lambda w: w != "")
    places = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(dims)).cast("int"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda d: F.size(F.filter(places, lambda p: p == d)).cast("double"))
    return texts.withColumn("v", counts)


def business_lines(dimension: DataFrame, filings: DataFrame, headings: DataFrame) -> DataFrame:
    """(filing_id, segment, pos): the segments that the dimension has for the company, else headings that speak of a segment."""
    known = filings.join(dimension.select(F.upper("ticker").alias("ticker"), "segment").distinct(), "ticker").select("filing_id", "segment")
    named = headings.where(F.lower("heading").rlike("segment$")).select("filing_id", F.trim(F.regexp_replace("heading", r"(?i)\s*segment$", "")).alias("segment")).join(known.select("filing_id").distinct(), "filing_id", "left_anti")
    both = known.unionByName(named).where(F.trim("segment") != "").distinct()
    return W.ranked(both, [F.col("segment")], "filing_id").withColumnRenamed("rank", "pos")


def choose_table(candidates: DataFrame) -> DataFrame:
    """(filing_id, table_idx, …) with `pick` 1 for the table a rule prefers: by signals, then by dimension."""
    ranked = W.financial_rank(candidates, "filing_id", most=80)
    return W.dimension_rank(ranked.withColumn("dimension", C.ranking_dimension(F.col("caption_text"), F.col("heading_context"), F.col("row_label_preview"))), "filing_id")


def layouts(grid: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Layouts and year columns by rule: the label column by its text, years from the head, units from the table's context."""
    k = list(X.KEYS)
    cells = X.cells(grid, *k)
    years = C.year_cols(cells, *k)
    head = years.join(cells.select(*k, "row_idx", F.col("col_idx").alias("col"), T.header_year(F.col("text")).alias("year")), [*k, "col", "year"]).groupBy(*k).agg(F.array_distinct(F.collect_list("row_idx")).alias("header_rows"))
    marked = cells.join(head, k, "left").withColumn("is_header", F.coalesce(F.array_contains("header_rows", F.col("row_idx")), F.lit(False)))
    columns = C.choose_item_col(marked.where("NOT is_header"), grid.select(*k).distinct().withColumn("proposed", F.lit(None).cast("int")), *k)
    units = T.units(F.col("units_hint"))
    out = columns.join(head, k, "left").join(candidates.select(*k, units.alias("units")), k, "left").select(*k, "item_col", F.lit(None).cast("int").alias("segment_col"), "header_rows", "units")
    return out, C.veto_year_cols(marked.drop("header_rows"), years, *k)


def segment_summaries(chunks: DataFrame, segments: DataFrame, most: int = 3) -> DataFrame:
    """(filing_id, segment, text): snippets for a summary by where they stand: segment note, notes, item 1, elsewhere."""
    rank = F.when(F.col("section") == "note_segment", 0).when(F.col("section").startswith("note"), 1).when(F.col("section") == "item1", 2).otherwise(3)
    found = chunks.join(segments, "filing_id").where(F.contains(F.lower("text"), F.lower("segment")) & ~F.col("is_toc"))
    best = W.ranked(found, [rank, F.col("chunk_idx")], "filing_id", "segment", most=most)
    return best.groupBy("filing_id", "segment").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]), " ").alias("text"))


def key_items(summaries: DataFrame) -> DataFrame:
    """(filing_id, segment, pos, item, span, text): product names in a segment's snippets, each with the sentence that it stands in as evidence; see describe.accepted_items.

    Sentences that say more than the name come first.  A plain capitalised word that only stands as a sentence of its own is
    no name: its capital is the sentence's.
    """
    from ..operators import describe as D

    items = summaries.select("filing_id", "segment", F.posexplode(D.products(F.col("text"))).alias("pos", "item"), "text")
    sentences = F.split("text", r"(?<=[.!?])\s+")
    found = F.filter(sentences, lambda x: F.contains(x, F.col("item")))
    telling = F.filter(found, lambda x: F.regexp_replace(x, r"[.!?]+$", "") != F.col("item"))
    bare = (F.size(found) > 0) & (F.size(telling) == 0) & F.col("item").rlike("^[A-Z][a-z]+$")
    return items.where(~bare).select("filing_id", "segment", "pos", "item", F.coalesce(F.get(telling, F.lit(0)), F.get(found, F.lit(0))).alias("span"), "text")


def sha(prompt: str) -> str:
    return hashlib.sha256(prompt.encode()).hexdigest()
