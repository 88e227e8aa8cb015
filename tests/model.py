"""What a matching job must return, from its definition (tests, small inputs).

A round is described by sets: the pool left over, the rows of it that are
candidates for a left row, the order that ranks them and the test that accepts
the first.  Scores are exact fractions; nothing here scans or breaks early.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from functools import reduce
from typing import NamedTuple

import numpy as np
import regex

from skulink.functions.text import COLOR_NAMES, ENGLISH_STOP_WORDS

STOP = frozenset(ENGLISH_STOP_WORDS)
MEASURE = regex.compile(r"\b\d+(\.\d+)?\s*(mL|mm)\b", regex.I)
COLOR = regex.compile(r"\b(" + "|".join(COLOR_NAMES) + r")\b", regex.I)
#: what leaves a name, in this order
NOISE = (COLOR, MEASURE, regex.compile(r"\b\d+\b"))

CONTENT = ("product_category", "product_sub_category", "product_id", "product_name",
           "product_quantity", "product_price", "product_url", "image_url", "product_desc")


def standard_name(name: str | None) -> str:
    return reduce(lambda s, noise: noise.sub("", s), NOISE, name or "").strip()


def word_set(name: str | None) -> frozenset[str]:
    return frozenset(regex.findall(r"\w+", standard_name(name)))


def tokens(text: str | None) -> list[str]:
    """Tokens of a text by hand: quotes, contractions, numbers, words, marks."""
    s = regex.sub(r"\bcannot\b", "can not", (text or "").lower())
    out, i = [], 0

    def run(pattern: str) -> str | None:
        m = regex.compile(pattern).match(s, i)
        return m[0] if m else None

    is_word = lambda c: regex.match(r"[\p{L}\p{N}_]", c) is not None
    while i < len(s):
        c = s[i]
        if c in " \t\n\x0b\f\r":
            i += 1
            continue
        if c == '"':
            opens = i == 0 or s[i - 1] in " \t\n\x0b\f\r([{<"
            out.append("``" if opens else "''")
            i += 1
            continue
        got = run(r"``|''|\.\.\.|n't|'\p{L}+")
        if got is None and is_word(c):
            got = run(r"\p{N}+([.,]\p{N}+)+")
            if got is None:
                got = run(r"[\p{L}\p{N}_]+(-[\p{L}\p{N}_]+)*")
                # a contraction is a token of its own: do n't
                tail = s[i:i + len(got) + 2]
                cut = tail.find("n't")
                if cut > 0:
                    got = tail[:cut]
        out.append(got or c)
        i += len(got or c)
    return out


def vector(text: str | None) -> np.ndarray:
    """Unit vector of the hash encoder: mean of 16 bytes of each kept token's MD5."""
    kept = [t for t in tokens(text) if t not in STOP][:126]
    if not kept:
        return np.zeros(0)
    raw = np.array([list(hashlib.md5(t.encode()).digest()) for t in kept], float)
    mean = ((raw - 127.5) / 127.5).mean(axis=0)
    size = np.linalg.norm(mean)
    return mean / size if size > 0 else mean


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    size = np.linalg.norm(a) * np.linalg.norm(b)
    return float(a @ b / size) if size > 0 else 0.0


class Outcome(NamedTuple):
    row: dict             # the right row shown as the match
    score: float
    recorded: dict        # the row whose copies leave the pool


class Job:
    """Left rows, right rows and the rules of one vendor's job."""

    def __init__(self, left, right, mode="direct", policy="none", hits=None, band=(30, 40)):
        by_pos = lambda rows: sorted(rows, key=lambda r: r["pos"])
        self.left, self.right = by_pos(left), by_pos(right)
        self.mode, self.policy, self.hits, self.band = mode, policy, hits or {}, band
        # the first row of an id stands for it
        self.description = {r["product_id"]: r.get("product_desc") for r in reversed(self.left)}
        self.by_id = {r["product_id"]: r for r in reversed(self.right)}
        self.words = {id(r): word_set(r["product_name"]) for r in (*left, *right)}
        self.vectors: dict = {}

    def score(self, a: dict, b: dict) -> Fraction:
        x, y = self.words[id(a)], self.words[id(b)]
        return Fraction(len(x & y), len(x | y)) if x | y else Fraction(0)

    def meaning(self, a: dict, b: dict) -> float:
        """Mean cosine of names and of descriptions."""
        def vec(text):
            if text not in self.vectors:
                self.vectors[text] = vector(text)
            return self.vectors[text]
        name = cosine(vec(a["product_name"]), vec(b["product_name"]))
        desc = cosine(vec(self.description[a["product_id"]]), vec(b.get("product_desc")))
        return (name + desc) / 2

    def plain(self, row: dict, pool: list[dict], k: int) -> Outcome | None:
        """Best score, the later row on ties; recorded: the pool's last row or the match."""
        ranked = sorted(pool, key=lambda r: (self.score(row, r), r["pos"]))
        if ranked and self.score(row, ranked[-1]) >= Fraction(k, 100):
            best = ranked[-1]
            return Outcome(best, float(self.score(row, best)), pool[-1])
        return None

    def in_band(self, row: dict, pool: list[dict], k: int) -> Outcome | None:
        """Only rows that score exactly k/100 count; meaning decides."""
        exact = [r for r in pool if self.score(row, r) == Fraction(k, 100)]
        if not exact:
            return None
        if self.mode == "direct":
            options = [(self.meaning(row, exact[0]), exact[0], exact[0])]
        elif not self.hits.get(row["product_id"]):
            options = [(k / 100, exact[-1], pool[-1])]
        else:
            found = [self.by_id[h] for h in self.hits[row["product_id"]] if h in self.by_id]
            options = [(self.meaning(row, h), exact[0], exact[0]) for h in found]
        good = [o for o in options if o[0] >= k / 100]
        if not good:
            return None
        score, shown, recorded = max(good, key=lambda o: o[0])
        return Outcome(shown, score, recorded)

    def results(self, ks) -> dict[int, tuple]:
        """{left pos: (round, right pos, score)} of the matched rows."""
        done: dict[int, tuple] = {}
        gone: set[tuple] = set()
        copy = lambda r: tuple(r.get(c) for c in CONTENT)
        lo, hi = self.band
        for k in ks:
            rule = self.in_band if self.mode != "off" and lo <= k <= hi else self.plain
            pool = [r for r in self.right if copy(r) not in gone]
            now = {r["pos"]: rule(r, pool, k) for r in self.left if r["pos"] not in done}
            now = {pos: o for pos, o in now.items() if o}
            done.update({pos: (k, o.row["pos"], o.score) for pos, o in now.items()})
            if self.policy != "none":
                gone |= {copy(o.row if self.policy == "matched" else o.recorded)
                         for o in now.values()}
        return done


def run(left, right, start=80, step=1, **rules) -> dict[int, tuple]:
    return Job(left, right, **rules).results(range(start, -1, -step))
