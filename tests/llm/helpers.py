"""Plain-Python versions of the operators' contracts."""

from __future__ import annotations

import collections
import itertools
import math
import re
import zlib

SF = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
#: Texts that every operator must take: null, empty, blank, one word, no letters, long, odd bytes.
ODD = [None, "", " \t\n ", "word", "...", "123 456", "é́ ñ 漢字 \U0001f600", "a" * 5000, "long " * 30_000, "x\x00y\x1cz", "same text here", "same text here"]


def lower(t: str | None) -> str:
    return (t or "").translate(_LOWER)


def held(doc_id: int, remainder: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == remainder


def shingles(t: str | None, width: int = 4) -> set[tuple[str, ...]]:
    w = SPACED.findall(lower(t))
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def jaccard_groups(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    sets, up = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def contamination(text: str | None, items: list[tuple[int, str | None]], width: int = 10) -> tuple[int, int, list[str]]:
    words, hit, who = ALNUM.findall(lower(text)), set(), set()
    for item, t in items:
        w = ALNUM.findall(lower(t))
        size = min(width, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == w[k : k + size]:
                    hit.update(range(at, at + size))
                    who.add(str(item))
    return len(words), len(hit), sorted(who)


def rule_counts(t: str | None) -> tuple[int, int, int, int, int]:
    t = t or ""
    w, seen, dup = SPACED.findall(t), set(), 0
    for line in t.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    counts = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    cover = {j for i in range(len(w) - 2) if counts[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(cover)


def unigram(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, int, float]]:
    """doc_id to (n_tokens, n_known, train_tokens, base_score)."""
    tokens = {i: [*SPACED.findall(lower(t)), " "] for i, t in rows}
    counts = collections.Counter(x for i, ts in tokens.items() if not held(i, 1) for x in ts)
    n, v = sum(counts.values()), len(counts)
    return {i: (len(ts), sum(x in counts for x in ts), n, sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in ts)) for i, ts in tokens.items()}


def twins(n: int = 1024, one: str = "a", other: str = "b") -> tuple[str, str]:
    """Two complementary strings of n letters that polynomial hashes modulo a power of two can't tell apart."""
    return tuple("".join((x, y)[bin(k).count("1") % 2] for k in range(n)) for x, y in ((one, other), (other, one)))
