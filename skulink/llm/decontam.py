"""Benchmark decontamination by one Aho-Corasick automaton (operator 9).

The benchmark's normalised texts (ASCII lower case, words without ASCII
punctuation) are cut into windows of 13 words; an item of fewer words is one
window.  Every distinct window is a pattern over word numbers; a document's
words become numbers (0 for a word no window has) and the automaton reads
them once, reporting every occurrence of every window.  Lower-casing and
blanking punctuation keep byte positions, so a hit is mapped back to
characters of the original text.

Size: windows are dealt by hash into blocks of ``BLOCK`` (window, item)
rows, so what one task holds and the driver ships is bounded whatever the
benchmark's size; usually there is one block and the whole job is a scan
without a shuffle.  With more blocks, each is one more scan of the documents
and the (few) documents with hits are merged by text digest.

Defined results: null or word-less text has no words and is clean; items
without words have no window; benchmark rows without an id are ignored;
repeated items count once; an empty benchmark or table gives clean or no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
from itertools import repeat

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skulink.llm.common import fresh, held

WINDOW = 13
#: (window, item) rows per automaton: about 13 nodes each, some hundred MB at most
BLOCK = 200_000
# A-Z to a-z; every other ASCII character that is no digit or letter to a blank
NORM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
             for c in range(256))
WORD = re.compile(rb"[^ ]+")

RESULT = ("n_words long, n_hit long, items array<string>, "
          "spans array<struct<start:int,end:int>>, hit array<int>")


def normal_words(raw: bytes) -> list[bytes]:
    """Words of the normalised text; byte positions are those of the original."""
    return raw.translate(NORM).split()


class Automaton:
    """Windows of one block, compiled; built once per Python worker and block."""

    def __init__(self, rows: list[tuple[str, str]]):
        windows: dict[bytes, set[str]] = {}
        for window, item in rows:
            windows.setdefault(window.encode(), set()).add(item)
        self.ids: dict[bytes, int] = {}
        self.trie = None
        if windows:
            self.trie = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for w, items in windows.items():
                key = tuple(self.ids.setdefault(x, len(self.ids) + 1) for x in w.split())
                self.trie.add_word(key, (len(key), tuple(items)))
            self.trie.make_automaton()

    @classmethod
    def of(cls, shared) -> "Automaton":
        name, rows = shared
        return held(name, lambda: cls(rows.value))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged runs [first, last] of hit words, and the items with a window here."""
        if self.trie is None or not words:
            return [], set()
        runs, items = [], set()
        key = tuple(map(self.ids.get, words, repeat(0)))
        for end, (size, found) in self.trie.iter(key):
            items.update(found)
            first = end - size + 1
            # ends come in rising order, so only the tail can still grow leftwards
            while runs and runs[-1][1] >= first - 1:
                first = min(first, runs.pop()[0])
            runs.append((first, end))
        return runs, items


def char_spans(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as (start, end) code points of the original text."""
    at = [m.span() for m in WORD.finditer(raw.translate(NORM))]
    out, pos, chars = [], 0, 0
    for first, last in runs:
        start, end = at[first][0], at[last][1]
        chars += len(raw[pos:start].decode("utf-8", "replace"))
        n = len(raw[start:end].decode("utf-8", "replace"))
        out.append((chars, chars + n))
        pos, chars = end, chars + n
    return out


def scanner(shared):
    """Column function: binary text -> RESULT, against one block's automaton."""
    @F.pandas_udf(RESULT)
    def scan(texts: pd.Series) -> pd.DataFrame:
        auto = Automaton.of(shared)
        out = []
        for raw in texts:
            words = normal_words(raw) if raw is not None else []
            runs, items = auto.scan(words)
            out.append((len(words), sum(b - a + 1 for a, b in runs), sorted(items),
                        [{"start": a, "end": b} for a, b in char_spans(raw, runs)] if runs else [],
                        [x for r in runs for x in r]))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "items", "spans", "hit"])
    return scan


def windows_of(bench: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct (window, item) rows of the benchmark."""
    @F.pandas_udf("array<string>")
    def cut_up(texts: pd.Series) -> pd.Series:
        out = []
        for raw in texts:
            w = normal_words(raw) if raw is not None else []
            out.append([b" ".join(w[i:i + window]).decode("utf-8", "replace")
                        for i in range(max(1, len(w) - window + 1))] if w else [])
        return pd.Series(out)
    return (bench.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("string").alias("item"),
                    F.explode(cut_up(F.col(text_col).cast("binary"))).alias("window")).distinct())


def with_hits(docs: DataFrame, bench: DataFrame, text_col: str = "text",
              item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
              block: int = BLOCK, out_col: str = "hits") -> DataFrame:
    """``docs`` with one more column: struct n_words, n_hit, items, spans.

    ``items`` are the sorted ids (as strings) of the items with an occurring
    window, ``spans`` the merged hit passages as code points of the text.
    """
    spark = docs.sparkSession
    pairs = windows_of(bench, item_col, item_text, window)
    n_blocks = max(1, math.ceil(pairs.count() / block))
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(n_blocks)))
    raw = F.col(text_col).cast("binary")

    def shared(k: int):
        # one block: about `block` rows by construction, never the whole benchmark
        rows = pairs.where(F.col("block") == k).select("window", "item").collect()
        return uuid.uuid4().hex, spark.sparkContext.broadcast(
            [(r["window"], r["item"]) for r in rows])

    if n_blocks == 1:
        return docs.withColumn(out_col, scanner(shared(0))(raw))
    return merge_blocks(docs, [scanner(shared(k)) for k in range(n_blocks)], text_col, out_col)


def merge_blocks(docs: DataFrame, scans: list, text_col: str, out_col: str) -> DataFrame:
    """Union of the blocks' hits per distinct text, joined back by text digest."""
    key, got = fresh(docs, "_text_key"), fresh(docs, "_merged")
    raw = F.col(text_col).cast("binary")
    texts = docs.where(raw.isNotNull()).select(F.sha2(raw, 256).alias(key), raw.alias("raw"))
    found = None
    for scan in scans:
        # a text's result is a function of the text: one row per digest is enough
        part = (texts.select(key, "raw", scan(F.col("raw")).alias("h"))
                .where(F.size("h.items") > 0)
                .select(key, "h.hit", "h.items", F.col("raw")))
        part = part.groupBy(key).agg(F.first("hit").alias("hit"), F.first("items").alias("items"),
                                     F.first("raw").alias("raw"))
        found = part if found is None else found.unionByName(part)

    @F.pandas_udf(RESULT)
    def join_runs(hits: pd.Series, items: pd.Series, texts: pd.Series) -> pd.DataFrame:
        out = []
        for hs, its, text in zip(hits, items, texts):
            runs: list[tuple[int, int]] = []
            for a, b in sorted((int(h[i]), int(h[i + 1])) for h in hs for i in range(0, len(h), 2)):
                if runs and a <= runs[-1][1] + 1:
                    runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
                else:
                    runs.append((a, b))
            out.append((len(normal_words(text)), sum(b - a + 1 for a, b in runs),
                        sorted({i for x in its for i in x}),
                        [{"start": a, "end": b} for a, b in char_spans(text, runs)],
                        [x for r in runs for x in r]))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "items", "spans", "hit"])

    # at most one row per block and text here
    merged = (found.groupBy(key).agg(F.collect_list("hit").alias("hs"),
                                     F.collect_list("items").alias("its"),
                                     F.first("raw").alias("raw"))
              .select(key, join_runs("hs", "its", "raw").alias(got)))

    @F.pandas_udf("long")
    def count_words(texts: pd.Series) -> pd.Series:
        return pd.Series([0 if t is None else len(normal_words(t)) for t in texts], dtype="int64")

    clean = F.struct(count_words(raw).alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                     F.array().cast("array<string>").alias("items"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
                     F.array().cast("array<int>").alias("hit"))
    return (docs.withColumn(key, F.sha2(raw, 256)).join(merged, key, "left")
            .withColumn(out_col, F.coalesce(F.col(got), clean)).drop(key, got))


def contaminated(hits: str = "hits") -> Column:
    """Hit words are at least one in twenty."""
    return (F.col(f"{hits}.n_hit") > 0) & (20 * F.col(f"{hits}.n_hit") >= F.col(f"{hits}.n_words"))


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Contract query: hit words and items of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = with_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", F.col("hits.n_words").alias("n_words"),
                      F.col("hits.n_hit").alias("n_hit"),
                      F.size("hits.items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "hits.items"), 256).alias("items_sha256"),
                      contaminated().alias("contaminated"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go, all others stay unchanged."""
    hits = fresh(docs, "_hits")
    out = with_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out_col=hits)
    return out.where(~contaminated(hits)).drop(hits)


def brute_force(docs: list[tuple], bench: list[tuple], window: int = WINDOW) -> list[tuple]:
    """The contract by comparing every window with every position (tests only)."""
    items = []
    for item, text in bench:
        w = normal_words(text.encode()) if text else []
        if w and item is not None:
            n = min(window, len(w))
            items.append((str(item), n, {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}))
    out = []
    for doc, text in docs:
        w = normal_words(text.encode()) if text else []
        hit, ids = set(), set()
        for item, n, wins in items:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit.update(range(i, i + n))
                    ids.add(item)
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), digest,
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out
