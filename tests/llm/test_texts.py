"""Main-text extraction, licence scans, mixing and token output."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyforge.llm import html_text, licenses, mix_sources, token_output
from tallyforge.llm.common import utf8

from .helpers import ODD, SF, SPACED, twins


# --- pages ----------------------------------------------------------------------------------------

FURNITURE = """<header class="site"><a href="/">Home</a> My site</header><nav><ul><li>Menu one</li><li>Menu two</li></ul></nav><div id="cookie-notice">We use cookies</div><div class="sidebar">Popular posts</div>"""
TAIL = """<section class="comments"><article class="comment"><p>First!</p></article></section><form><input name="q"><button>Search</button><p>Find things</p></form><aside>Related</aside><footer>&copy; site</footer>"""


def page(article: str, head: str = FURNITURE, tail: str = TAIL) -> str:
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{x:1}}</style><script>var t = '</p><p>code';</script></head><body>{head}<article>{article}</article>{tail}</body></html>"


def texts_of(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "1 AS path", "2 AS block")
    return {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()}


def test_article_without_furniture(spark):
    body = "<header><h1>A &amp; B</h1></header><p>One\n  two&nbsp;three<br>four <b>bold</b></p><div class='ad'>Buy!</div><p>Five<p>Six &lt;tag&gt; &#233;<ul><li>x<li>y</ul><table><tr><td>a<td>b</table><!-- hidden --><p hidden>no</p><p style='display: none'>no</p>"
    want = "A & B\n\nOne two three four bold\n\nFive\n\nSix <tag> é\n\nx\n\ny\n\na\n\nb"
    rows = [(1, "http://h.example/en/10", page(body)), (2, "http://h.example/en/11?x=1", page("<p>Other</p>")), (3, "http://alone.example/z", page(body))]
    got = texts_of(spark, rows)
    assert got[1] == (want, len(want)) and got[3][0] == want and got[2][0] == "Other"


def test_copied_articles_stay(spark):
    rows = [(k, f"http://h.example/en/1{k}", page("<p>Same words everywhere.</p>")) for k in range(4)]
    assert {t for t, _ in texts_of(spark, rows).values()} == {"Same words everywhere."}


def test_shared_lines_go_where_nothing_marks_the_article(spark):
    plain = lambda own: f"<body><div>Site name</div><div>Latest news</div>{own}<div>Contact us</div></body>"
    rows = [(1, "http://h.example/a/10.html", plain("<p>First story.</p><p>It is long.</p>")), (2, "http://h.example/a/11/", plain("<p>Second story.</p>")), (3, "http://other.example/a/10", plain("<p>Third.</p>"))]
    got = texts_of(spark, rows)
    assert got[1][0] == "First story.\n\nIt is long." and got[2][0] == "Second story."
    assert got[3][0] == "Site name\n\nLatest news\n\nThird.\n\nContact us"  # no neighbour, no marks


def test_marked_pages_are_not_compared(monkeypatch):
    monkeypatch.setattr(html_text, "shared_lines", lambda a, b: pytest.fail("compared"))
    one, two = (html_text.parse(page(f"<p>{x}</p><p>Both</p>")) for x in ("One", "Two"))
    assert html_text.main_lines(one, [two]) == ["One", "Both"]


def test_undeclared_notices_in_marked_articles_go(spark):
    """A line that every neighbour's article has, of four or more that are no copies; headings, copies and what one neighbour lacks stay."""
    story = lambda k: f"<h2>Summary</h2><p>Story {k} {'is its own. ' * 5}</p><p>Read more on our site.</p>" + ("<p>Often said.</p>" if k != 3 else "") + f"<p>End {k}.</p>"
    rows = [(k, f"http://h.example/a/1{k}", page(story(k))) for k in range(6)] + [(k, f"http://few.example/a/1{k}", page(story(k))) for k in range(10, 14)]
    rows += [(k, f"http://copies.example/a/{k}", page("<p>Same words everywhere.</p><p>Twice.</p>")) for k in range(20, 27)]
    got = {k: t.split("\n\n") for k, (t, _) in texts_of(spark, rows).items()}
    for k in range(6):
        assert got[k] == ["Summary", f"Story {k} {'is its own. ' * 5}".strip(), *(["Often said."] if k != 3 else []), f"End {k}."]
    assert all("Read more on our site." in got[k] for k in range(10, 14))  # three neighbours
    assert all(got[k] == ["Same words everywhere.", "Twice."] for k in range(20, 27))


def test_copies_of_pages_without_marks_stay(spark):
    plain = lambda own: f"<body><div>Site name</div><div>Latest news</div>{own}<div>Contact us</div></body>"
    story, other = (f"{name} story. " + "It is long. " * 30 for name in ("One", "Another"))
    rows = [(k, f"http://h.example/a/1{k}", plain(f"<p>{story}</p>")) for k in range(3)] + [(3, "http://h.example/a/19", plain(f"<p>{other}</p>"))]
    rows += [(k, "http://twice.example/a", plain(f"<p>{story}</p>")) for k in (4, 4, 5)]
    got = texts_of(spark, rows)
    assert [got[k][0] for k in range(4)] == [story.strip()] * 3 + [other.strip()]  # against the next one that is no copy
    assert {got[k][0] for k in (4, 5)} == {f"Site name\n\nLatest news\n\n{story.strip()}\n\nContact us"}  # nothing but copies


@pytest.mark.parametrize("part_rows", [1, 3, 256])
def test_every_page_meets_the_nearest_url_of_its_host(spark, part_rows):
    rng = random.Random(4)
    slugs = sorted({"/".join(rng.choice(("news", "sport", "a-long-story", "b")) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 4))) for _ in range(45)})
    line = lambda i, j: f"<p>pair {min(i, j)} {max(i, j)}</p>"  # noqa: E731  only these two pages share it
    rows = [(i, f"http://h.example/{slug}", f"<p>{'own ' * 400}{i}</p>" + "".join(line(i, j) for j in range(len(slugs)) if j != i)) for i, slug in enumerate(slugs)]
    rng.shuffle(rows)
    pages = spark.createDataFrame(rows + [(99, "http://alone.example/news1", "<p>pair 0 1</p>")], "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages, part_rows=part_rows).collect()}
    alike = lambda i, j: len(os.path.commonprefix([slugs[i], slugs[j]]))
    for i in range(len(slugs)):
        near = max((j for j in (i - 1, i + 1) if 0 <= j < len(slugs)), key=lambda j: alike(i, j))
        assert alike(i, near) == max(alike(i, j) for j in range(len(slugs)) if j != i)
        assert [j for j in range(len(slugs)) if j != i and line(i, j)[3:-4] not in got[i].split("\n\n")] == [near]
    assert got[99] == "pair 0 1" and len(got) == len(rows) + 1


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "not a url", "<p>a"), (4, "http://h/x", "plain < text > & more"), (5, "http://h/x", "<article><p>x" + "y " * 50_000), (6, "http://h/x", "<p title='a>b'>c</p><script>never closed"), (6, "http://h/x", "<article>twice</article>")]
    got = texts_of(spark, rows)
    assert got[1] == ("", 0) and got[2] == ("", 0) and got[3][0] == "a" and got[4][0] == "plain < text > & more"
    assert got[5][1] == len(got[5][0]) > 99_000
    assert texts_of(spark, []) == {}


def test_main_text_against_a_plain_reading(spark):
    """The test table's pages through the standard library's parser: the blocks of the article, but for those of class `ad`."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__()
            self.open, self.blocks, self.now, self.opaque = [], [], "", 0

        def end_block(self):
            if self.now.split() and "article" in self.open and not any(t in ("nav", "footer", "aside", "ad") for t in self.open):
                self.blocks.append(" ".join(self.now.split()))
            self.now = ""

        def handle_starttag(self, tag, attrs):
            if tag in ("script", "style", "title"):
                self.opaque += 1
            if tag == "br":
                self.now += " "
            elif tag not in ("a", "b", "meta", "i", "em", "span", "strong"):
                self.end_block()
                if tag == "p" and self.open and self.open[-1] == "p":
                    self.open.pop()
                self.open.append("ad" if ("class", "ad") in attrs else tag)

        def handle_endtag(self, tag):
            if tag in ("script", "style", "title"):
                self.opaque -= 1
            if tag in ("a", "b", "i", "em", "span", "strong"):
                return
            self.end_block()
            names = [tag, "ad"] if tag == "div" else [tag]
            if any(t in names for t in self.open):
                while self.open.pop() not in names:
                    pass

        def handle_data(self, data):
            if not self.opaque:
                self.now += data

    def plain(source):
        reader = Reader()
        reader.feed(source or "")
        reader.close()
        reader.end_block()
        return "\n\n".join(reader.blocks)

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.op4(spark, SF).collect()}
    assert set(got) == set(pages)
    for k, source in pages.items():
        assert got[k] == (plain(source), len(plain(source)))


def test_names_that_only_hold_a_word_of_furniture(spark):
    keep = ["side-effects", "tags-explained", "commentary", "advice", "share-price", "notice-of-meeting", "headers-and-footers"]
    drop = ["ad", "ad-slot-3", "site-header", "cookie-notice", "comments_list", "related-posts", "x sidebar y", "Share-Buttons"]
    body = "".join(f"<p class='{c}'>{c}</p>" for c in keep + drop) + "<div id='notice-period'>notice-period</div><div id='top-nav'>menu</div>"
    got = texts_of(spark, [(1, "http://h.example/a", f"<main>{body}</main>")])
    assert got[1][0].split("\n\n") == [*keep, "notice-period"]


def test_deep_pages_take_time_in_proportion():
    import time

    def seconds(n: int) -> float:
        began = time.perf_counter()
        page = html_text.parse("<div>x<b>" * n + "</i></p>" * n)
        assert len(page.lines) == n
        return time.perf_counter() - began

    seconds(1000)
    small, large = (min(seconds(n) for _ in range(3)) for n in (5_000, 50_000))  # 450 KB
    assert large < 30 * small


def test_longest_common_lines():
    a, b = (list(zip("s" * 9, x)) for x in ("abcabba", "cbabac"))
    assert sum(html_text.shared_lines(a, b)) == 4
    rng = random.Random(3)
    for _ in range(60):
        x, y = ([("s", rng.choice("abc")) for _ in range(rng.randrange(9))] for _ in range(2))
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                best[i + 1][j + 1] = best[i][j] + 1 if x[i] == y[j] else max(best[i][j + 1], best[i + 1][j])
        assert sum(html_text.shared_lines(x, y)) == best[-1][-1]


# --- licences -------------------------------------------------------------------------------------


def scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS ids", "'q' AS names")
    return {r["doc_id"]: (r["sentences"], r["n_sentences"], r["licence"], r["licences"]) for r in licenses.scan(docs).collect()}


def test_every_sentence_is_known(spark):
    got = scan(spark, list(licenses.SENTENCES.values()))
    assert [got[k][0] for k in range(len(licenses.SENTENCES))] == [str(k) for k in licenses.SENTENCES]


def test_rules_need_their_order(spark):
    s = licenses.SENTENCES
    got = scan(spark, [f"Text. {s[5]} More words. {s[6]}", f"{s[6]} {s[5]}", f"LICENSED under the apache license,  version 2.0\nYou may", f"{s[1]}\n{s[4]}", "a licence", "It is licensed under CC BY 4.0."])
    assert got[0] == ("5,6", 2, "MIT", "MIT") and got[1] == ("6,5", 2, "", "")
    assert got[2][2] == "Apache-2.0" and got[3] == ("1,4", 2, "Apache-2.0", "Apache-2.0,MIT")
    assert got[4] == ("", 0, "", "") and got[5] == ("", 0, "", "")


#: Published headers and texts, wrapped as they are.
WRAPPED = {
    "Apache-2.0": """# Copyright 2020 Someone
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
import os""",
    "MIT": """MIT License\n\nCopyright (c) 2020 Someone\n
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.\n""",
    "GPL-3.0-or-later": """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.\r\n *\r\n * This program is distributed""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "MPL-2.0": """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "CC0-1.0": "Creative Commons Legal Code\n\nCC0 1.0 Universal\n\n    CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM",
}


def test_wrapped_licence_texts(spark):
    got = scan(spark, list(WRAPPED.values()))
    assert {name: got[k][2] for k, name in enumerate(WRAPPED)} == {name: name for name in WRAPPED}
    assert got[0][0] == "23,2,3,24" and got[1][0] == "21,6" and got[2][0] == "14,26,27,15"


def test_every_further_sentence_is_known_however_it_is_wrapped(spark):
    s = licenses.MORE_SENTENCES
    for wrap in (s.values(), [x.replace(" - ", " ").replace(" ", "\n# ") for x in s.values()], [f"Some words\n{x.replace(' ', '  ')}\nMore words" for x in s.values()]):
        got = scan(spark, list(wrap))
        assert [got[k][0].removesuffix(",2") for k in range(len(s))] == [str(k) for k in s]  # 23 and 56 end in sentence 2


def test_versions_are_kept(spark):
    form = "This Source Code Form is subject to the terms of the Mozilla Public License, v. {}. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/{}/."
    header = 'The contents of this file are subject to the Mozilla Public License Version\n1.1 (the "License"); you may not use this file except in compliance with\nthe License. You may obtain a copy of the License at'
    got = scan(spark, [form.format("2.0", "2.0"), form.format("2.0", "2.0").replace("v. ", "v.\n"), form.format("1.1", "1.1"), header, "Licensed under the Apache License, Version 1.1."])
    assert [got[k][2] for k in range(5)] == ["MPL-2.0", "MPL-2.0", "", "MPL-1.1", ""]


def test_licences_of_odd_texts(spark):
    got = scan(spark, ODD)
    assert set(got.values()) == {("", 0, "", "")} and len(got) == len(ODD)
    assert scan(spark, []) == {}


def test_licence_plan_has_no_python(spark):
    plan = licenses.op9(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Exchange"))


# --- mixing ---------------------------------------------------------------------------------------


def poured(sizes: dict, weights: dict, budget: float, cap: float) -> dict:
    """Targets by clamping and resharing until none is above its cap."""
    fixed: dict = {}
    while True:
        free = {s: w for s, w in weights.items() if s not in fixed}
        left = budget - sum(fixed.values())
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = {s: cap * sizes[s] for s in free if share[s] > cap * sizes[s]}
        if not over:
            return fixed | share
        fixed |= over


@pytest.mark.parametrize("seed", range(3))
def test_mix_targets_and_takings(spark, seed):
    rng = random.Random(seed)
    sources = ["b", "a", "Z", "é", None, "c"][: 3 + seed]
    rows = [(i, " ".join(["w"] * rng.choice((0, 1, 5, 40))), rng.choice([sources[0]] * 4 + sources)) for i in range(300)]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, source string").selectExpr("*", "1 AS target", "2 AS size", "3 AS key")
    got = mix_sources.mix(docs).collect()
    assert len(got) == len(rows) + 3
    size = {s: sum(r["size"] for r in got if r["source"] == s) for s in {r["source"] for r in got}}
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    want = poured(size, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(size.values()), 2.0)
    largest = max(r["size"] for r in got)
    for s in size:
        assert all(r["target"] == pytest.approx(want[s]) for r in got if r["source"] == s)
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - want[s]) <= 2 * largest
    assert all(r["taken"] == r["size"] * r["reps"] and 0 <= r["reps"] <= 2 for r in got)
    assert sorted(map(str, mix_sources.mix(docs).collect())) == sorted(map(str, got))
    out = mix_sources.mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r["reps"] for r in got)


def test_mix_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(ODD)] + [(None, "a b", "s"), (None, None, "t")], "doc_id long, text string, source string")
    got = mix_sources.mix(docs).collect()
    assert len(got) == len(ODD) + 2 and all(r["size"] == len(SPACED.findall(t or "")) for r, t in [(r, dict(enumerate(ODD)).get(r["doc_id"], "a b")) for r in got if r["doc_id"] is not None])
    assert mix_sources.mix(docs.limit(0)).count() == 0


# --- token ids ------------------------------------------------------------------------------------


def encoder():
    with open(token_output.tokenizer_path(), encoding="utf-8") as f:
        return token_output.Encoder(f.read())


def test_ids_are_the_librarys(spark):
    own = ["  a", "a  ", "\n\n x\ty", "don't we're 12 34x's.", "a b c　 d", "<|endoftext|> x <|endoftext|>", "\x1c a\x1fb \x85 c", "  \n  foo\n\n  bar", " ​ x", "a.b,c!d?e;f:g", "x" * 70_000 + " y", "((a)) [b] 'c' ''' ...", "Ġ Ċ"]
    texts = [t or "" for t in ODD] + own + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    e = encoder()
    want = [e.tok.encode(t, add_special_tokens=False).ids for t in texts]
    data, at = utf8(pa.array(texts))
    for _ in range(2):  # the second time from what is held
        assert [x.tolist() for x in e.encode(data, at)] == want
    e.most, e.new = 10, e.new
    for k in range(0, len(texts), 7):
        data, at = utf8(pa.array(texts[k : k + 7]))
        assert [x.tolist() for x in e.encode(data, at)] == want[k : k + 7]


def test_pieces_are_told_apart_by_all_their_bytes():
    """Long pieces with equal ends, and strings that polynomial hashes take for one."""
    e, (x, y) = encoder(), twins()
    texts = [x, y, f"{x} {y}", f"{y} {x}", "abcdefgh" + x + "stuvwxyz", "abcdefgh" + y + "stuvwxyz", "abcdefgh-1-stuvwxyz", "abcdefgh-2-stuvwxyz"]
    for t in texts:  # one call for each, so that later ones meet what is held
        data, at = utf8(pa.array([t]))
        assert e.encode(data, at)[0].tolist() == e.tok.encode(t, add_special_tokens=False).ids
    same = e.old.place(np.zeros(1, np.uint64), np.zeros((1, 3), np.uint64))
    assert same[0] == -1
    e.new.hash[:] = e.new.hash[0]  # equal hashes for all short pieces: bytes still decide
    data, at = utf8(pa.array(["a word, an other word"]))
    assert e.encode(data, at)[0].tolist() == e.tok.encode("a word, an other word", add_special_tokens=False).ids


def test_short_pieces_of_one_hash_are_told_apart():
    e = encoder()
    data, at = utf8(pa.array(["a word, an other word"]))
    e.encode(data, at)
    assert len(e.new.hash) > 3
    e.new.hash[:] = e.new.hash[0]
    for text in ("a word, an other word", "other words, a word"):
        data, at = utf8(pa.array([text]))
        assert e.encode(data, at)[0].tolist() == e.tok.encode(text, add_special_tokens=False).ids


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 10, 1000):
        keys = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        seeds, slots = token_output.perfect_hash(token_output._key_hash(keys))
        assert sorted(slots) == list(range(len(keys)))


def test_round_trip(spark, tmp_path):
    rows = [(i * 3 - 9, t) for i, t in enumerate(ODD)] + [(5, "x y"), (5, None), (5, "x y"), (None, "b"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS start", "'k' AS keys", "2 AS part")
    path, e = str(tmp_path / "ids"), encoder()
    with open(token_output.tokenizer_path(), encoding="utf-8") as f:
        token_output.write_ids(docs, path, f.read(), shard_ids=50, partitions=3)
    got = token_output.read_back(spark, path).collect()
    at, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*e.tok.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    keys = spark.createDataFrame([(5,), (-9,), (1 << 50,), (6,)], "doc_id long")
    found = {r["doc_id"]: r["ids"] for r in token_output.fetch(spark, path, keys).collect()}
    have = {i: t for i, t in reversed(rows) if i is not None}
    assert set(found) == {k for k in (5, -9, 6) if k in have}
    assert found[-9] == [*e.tok.encode(have[-9] or "", add_special_tokens=False).ids, 0]


def test_a_key_in_very_many_rows(spark, tmp_path):
    """It fills several shards and partitions, and each of its records is found."""
    rows = [(7, f"row {k % 50}") for k in range(400)] + [(None, "n")] * 100 + [(k, "z") for k in range(20) if k != 7]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path, e = str(tmp_path / "ids"), encoder()
    with open(token_output.tokenizer_path(), encoding="utf-8") as f:
        token_output.write_ids(docs, path, f.read(), shard_ids=60, partitions=4)
    shards = spark.read.parquet(path)
    assert shards.count() > 20 and shards.select("part").distinct().count() == 4 and shards.selectExpr("max(n_ids)").first()[0] < 70
    got = token_output.read_back(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]
    keys = spark.createDataFrame([(7,), (None,), (3,), (99,)], "doc_id long")
    found = [(r["doc_id"], tuple(r["ids"])) for r in token_output.fetch(spark, path, keys).collect()]
    want = [(i, (*e.tok.encode(t, add_special_tokens=False).ids, 0)) for i, t in rows if i in (7, 3)]
    assert sorted(found) == sorted(want)
    assert token_output.fetch(spark, path, keys.limit(0)).count() == 0


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_output.token_output(docs, path=str(tmp_path / "none")).count() == 0
