"""BPE encoding and decoding with a minimal acyclic transducer lexicon (operator 5).

The tokenizer lower-cases, drops white space and splits a text into pieces
(words, digits, runs of symbols) that are merged independently.  The corpus'
frequent pieces are encoded once on the driver and compiled into a minimal
acyclic automaton: equal suffixes share states, and every transition carries
the number of smaller words it skips, so the sum along a path is the word's
index and thereby its row of token ids.  The automaton is a few flat arrays
in one block that each Python worker memory-maps; a batch's new pieces walk
it all together, one byte per step.  Pieces that it doesn't know are merged
exactly (lowest rank first, then leftmost): short ones together as rows of a
matrix, long ones by a heap that keeps it n log n.  The lexicon only saves
work: its size (``LEXICON`` pieces, a documented bound of what the driver
holds) cannot change a result.

Texts of ASCII and Latin-1 letters are split by one regular expression;
chunks with any other character go through the tokenizer's own normaliser
and splitter.  White space never belongs to a piece and no normalisation
reaches across it, so those work chunk by chunk.

Piece counts cover all documents: counted per task, summed in Spark; the
driver takes only the ``LEXICON`` most frequent.

Defined results: null text encodes as empty (no tokens, empty decoded text);
repeated rows are encoded each; the two special strings in a text become their special ids; white space of
any kind separates; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import tempfile
import uuid
from collections import Counter, defaultdict
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skulink.llm.common import held, most_frequent, release
from skulink.session import cut

TOKENIZER = "word_bpe_49k.json"
LEXICON = 120_000         # frequent pieces in the automaton
LONGEST = 48              # bytes of the longest piece that may enter it
COUNTER_ROWS = 100_000    # pieces a counting task holds before it writes them out
CACHE_ROWS = 150_000   # pieces a worker remembers per generation (two generations)
BLOCK_PIECES = 100_000  # pieces of texts encoded together
SHORT = 40             # bytes of the longest piece that is merged in a matrix
MERGE_ROWS = 4096      # its rows
BATCH_TEXTS = 256      # texts taken out of an Arrow batch at a time
# white space as Unicode defines it; str.split() also splits at \x1c-\x1f
SEPARATORS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
EXTRA = re.compile("[\x1c-\x1f]")
# what the regular expression below may split: ASCII and Latin-1 letters
PLAIN = re.compile("[^\x00-\x1b\x20-\x7f\xc0-\xff]")
PLAIN_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]"
                         "|[^\t-\r a-z0-9\xdf-\xf6\xf8-\xff]+")


# the characters that stand for bytes: printable ones for themselves, others from 256 on
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
BYTE_CHARS = [chr(b if b in _SHOWN else 256 + _HIDDEN.index(b)) for b in range(256)]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


class WordBpe:
    """The tokenizer's vocabulary and merges, with an own exact merge."""

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.normalizer = Tokenizer.from_file(path).normalizer
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.splitter = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), "removed",
                                             invert=split["invert"])
        self.to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        self.names = {i: t for t, i in self.vocab.items()}
        self.ranks = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[a, b] = rank
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names.update({i: t for t, i in self.special.items()})
        self.split_chunks: dict[str, tuple[str, ...]] = {}
        self.special_re = re.compile("|".join(
            re.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        # the same as arrays: first ids by byte, merges sorted by their pair of ids
        id_of = lambda t: self.vocab.get(t, -1)
        self.inner = np.array([id_of(c) for c in BYTE_CHARS], np.int32)
        self.final = np.array([id_of(c + self.suffix) for c in BYTE_CHARS], np.int32)
        merges = np.array([(id_of(a), id_of(b), id_of(a + b), rank)
                           for (a, b), rank in self.ranks.items()], np.int64).reshape(-1, 4)
        merges = merges[(merges[:, :3] >= 0).all(axis=1)]
        self.none = len(self.ranks)
        self.merged = np.full(self.none + 1, -1, np.int32)
        self.merged[merges[:, 3]] = merges[:, 2]
        pair = merges[:, 0] << 32 | merges[:, 1]
        order = np.argsort(pair)
        self.pair = np.append(pair[order], np.iinfo(np.int64).max)
        self.pair_rank = np.append(merges[order, 3], self.none).astype(np.int32)

    def merge(self, piece: str) -> list[int]:
        """Ids of one pre-split piece: lowest rank first, leftmost on ties."""
        if not (piece.isascii() and piece.isalnum()):  # those stand for themselves
            piece = "".join(p for p, _ in self.to_bytes.pre_tokenize_str(piece))
        parts = list(piece)
        parts[-1] += self.suffix
        parts = [p for p in parts if p in self.vocab]  # there is no unknown token
        return self.merge_short(parts) if len(parts) <= 40 else self.merge_long(parts)

    def merge_short(self, parts: list[str]) -> list[int]:
        get, none = self.ranks.get, len(self.ranks)
        rank = [get(p, none) for p in zip(parts, parts[1:])]
        while rank:
            best = min(rank)
            if best == none:
                break
            i = rank.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del rank[i]
            if i < len(rank):
                rank[i] = get((parts[i], parts[i + 1]), none)
            if i:
                rank[i - 1] = get((parts[i - 1], parts[i]), none)
        return [self.vocab[p] for p in parts]

    def merge_long(self, parts: list[str]) -> list[int]:
        """The same by a heap, n log n."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if j >= n or (parts[i], parts[j]) != pair:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = pair[0] + pair[1], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                p = (parts[i], parts[after[i]])
                if p in ranks:
                    heapq.heappush(heap, (ranks[p], i, p))
            if before[i] >= 0:
                p = (parts[before[i]], parts[i])
                if p in ranks:
                    heapq.heappush(heap, (ranks[p], before[i], p))
        return [self.vocab[p] for p in parts if p is not None]

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, ``none`` where there is no merge."""
        pair = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.pair, pair)
        return np.where(self.pair[at] == pair, self.pair_rank[at], self.none)

    def merge_all(self, pieces: list[str], raw: list[bytes]):
        """:meth:`merge` of many pieces (``raw``: as bytes): parts of (places, numbers of ids, ids in a row)."""
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(size, kind="stable")           # rows of a matrix are about equally long
        short = int(np.searchsorted(size[order], SHORT, "right"))
        for k in range(0, short, MERGE_ROWS):
            at = order[k:min(k + MERGE_ROWS, short)]
            yield at, *self.merge_rows([raw[i] for i in at.tolist()], size[at])
        for i in order[short:]:
            ids = self.merge(pieces[i])
            yield np.array([i]), np.array([len(ids)]), np.array(ids, np.int32)

    def merge_rows(self, raw: list[bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces as rows of a matrix of ids: each step merges every row's best pair."""
        width = max(int(size.max()), 1)
        text = np.frombuffer(b"".join([r.ljust(width, b"\0") for r in raw]), np.uint8).reshape(-1, width)
        column, row = np.arange(width), np.arange(len(raw))
        ids = self.inner[text]
        ids[row, size - 1] = self.final[text[row, size - 1]]
        ids[column >= size[:, None]] = -1
        # bytes that the vocabulary lacks are dropped before anything is merged
        ids = np.take_along_axis(ids, np.argsort(ids < 0, axis=1, kind="stable"), axis=1)
        size = (ids >= 0).sum(axis=1)
        # a pair's rank stands at its left id; what has been merged away has none
        rank = np.full((len(raw), width), self.none, np.int32)
        pair = (ids[:, :-1] >= 0) & (ids[:, 1:] >= 0)
        rank[:, :-1][pair] = self.rank_of(ids[:, :-1][pair], ids[:, 1:][pair])
        after, before = np.tile(column + 1, (len(raw), 1)), np.tile(column - 1, (len(raw), 1))
        while True:
            i = rank[row].argmin(axis=1)                  # the leftmost of the lowest
            best = rank[row, i]
            more = best < self.none
            row, i, best = row[more], i[more], best[more]
            if not len(row):
                break
            j = after[row, i]
            k = after[row, j]
            ids[row, i], ids[row, j], rank[row, j], after[row, i] = self.merged[best], -1, self.none, k
            rank[row, i] = self.none
            has = k < size[row]
            r, a, b = row[has], i[has], k[has]
            before[r, b] = a
            rank[r, a] = self.rank_of(ids[r, a], ids[r, b])
            b = before[row, i]
            has = b >= 0
            r, a, b = row[has], i[has], b[has]
            rank[r, b] = self.rank_of(ids[r, b], ids[r, a])
        kept = ids >= 0
        return kept.sum(axis=1), ids[kept]

    def chunk_pieces(self, chunk: str) -> tuple[str, ...]:
        """Pieces of a chunk without white space or special strings."""
        norm = self.normalizer.normalize_str(chunk)
        return tuple(p for p, _ in self.splitter.pre_tokenize_str(norm) if p)

    def pieces(self, text: str) -> list[str]:
        """Pieces and special strings of a text, in order."""
        if "<|" not in text:
            return self.plain_pieces(text)
        out, pos = [], 0
        for m in self.special_re.finditer(text):
            out += self.plain_pieces(text[pos:m.start()])
            out.append(m[0])
            pos = m.end()
        return out + self.plain_pieces(text[pos:])

    def plain_pieces(self, text: str) -> list[str]:
        if text.isascii() and not EXTRA.search(text) or not PLAIN.search(text):
            return PLAIN_PIECE.findall(text.lower())
        seen, out = self.split_chunks, []
        if len(seen) > CACHE_ROWS:
            seen.clear()
        for c in chunks_of(text):
            got = seen.get(c)
            if got is None:
                got = seen[c] = (self.chunk_pieces(c) if PLAIN.search(c)
                                 else tuple(PLAIN_PIECE.findall(c.lower())))
            out += got
        return out


def chunks_of(text: str) -> list[str]:
    if EXTRA.search(text):
        return [c for c in SEPARATORS.split(text) if c]
    return text.split()


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """Minimal acyclic transducer of the entries as one block of flat arrays.

    Words are added in order; what can't change any more is replaced by an
    equal state seen before (same finality and transitions).  Layout (uint32):
    sizes, then per transition a sorted (state, byte) key, its target and the
    number of words it skips, the finality of states, the id rows.
    """
    words = sorted(entries)
    register: dict[tuple, int] = {}
    finished: list[tuple[bool, tuple]] = []        # state -> (final, ((byte, state), ...))

    def settle(final: bool, edges: list) -> int:
        key = (final, tuple(edges))
        if key not in register:
            register[key] = len(finished)
            finished.append(key)
        return register[key]

    path: list[list] = [[False, []]]               # states of the last word, not settled yet
    last = b""
    for w in [*words, None]:
        keep = 0
        if w is not None:
            while keep < min(len(w), len(last)) and w[keep] == last[keep]:
                keep += 1
        while len(path) - 1 > keep:
            final, edges = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(final, edges)))
        if w is None:
            break
        for _ in w[keep:]:
            path.append([False, []])
        path[-1][0] = True
        last = w
    root = settle(*path[0])
    count = [0] * len(finished)                    # words below each state; children come first
    keys, targets, skips = [], [], []
    for s, (final, edges) in enumerate(finished):
        n = int(final)
        for byte, t in edges:
            keys.append(s * 256 + byte)
            targets.append(t)
            skips.append(n)
            n += count[t]
        count[s] = n
    rows = [entries[w] for w in words]
    starts = np.zeros(len(rows) + 1, np.uint32)
    np.cumsum([len(r) for r in rows], out=starts[1:]) if rows else None
    flat = np.array([i for r in rows for i in r], np.uint32)
    finals = np.array([f for f, _ in finished], np.uint32)
    head = np.array([root, len(keys), len(finals), len(rows), len(flat)], np.uint32)
    return b"".join(np.asarray(a, np.uint32).tobytes()
                    for a in (head, keys, targets, skips, finals, starts, flat))


class Lexicon:
    """The compiled block, memory-mapped; lookups of many words at once."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as f:        # no name: gone with the worker
            f.write(block)
            f.flush()
            self.map = mmap.mmap(f.fileno(), len(block), access=mmap.ACCESS_READ)
        a = np.frombuffer(self.map, np.uint32)
        self.root, n_edges, n_states, n_words, n_flat = (int(x) for x in a[:5])
        at = 5
        parts = []
        for n in (n_edges, n_edges, n_edges, n_states, n_words + 1, n_flat):
            parts.append(a[at:at + n])
            at += n
        self.keys, self.targets, self.skips, self.finals, self.starts, self.flat = parts

    def find(self, words: list[bytes]) -> np.ndarray:
        """Word index per word, -1 where the lexicon lacks it."""
        out = np.full(len(words), -1, np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        live = np.flatnonzero((size > 0) & (size <= LONGEST)) if len(self.keys) else out[:0]
        if not len(live):
            return out
        raw = np.frombuffer(b"".join(words[i].ljust(LONGEST, b"\0") for i in live), np.uint8)
        raw = raw.reshape(-1, LONGEST)
        state = np.full(len(live), self.root, np.int64)
        number = np.zeros(len(live), np.int64)
        row = np.arange(len(live))
        for step in range(LONGEST + 1):
            done = size[live] == step
            if done.any():
                hit = done & (self.finals[state] == 1)
                out[live[hit]] = number[hit]
                state, number, row, live = state[~done], number[~done], row[~done], live[~done]
            if not len(live):
                break
            key = state * 256 + raw[row, step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            state, number = self.targets[at[ok]].astype(np.int64), number[ok] + self.skips[at[ok]]
            row, live = row[ok], live[ok]
        return out

    def ids(self, index: int) -> list[int]:
        return self.flat[self.starts[index]:self.starts[index + 1]].tolist()


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``flat[start:start + size]`` one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Memory:
    """Pieces numbered in the order they are met, and where their ids lie in one flat array."""

    def __init__(self):
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__     # a new piece gets the next number
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)

    def close(self) -> "Memory":
        """No piece is added any more (and the numbers refer to themselves no longer)."""
        self.number.default_factory = None
        return self

    def add(self, n: int, parts) -> None:
        """Ids of the next ``n`` pieces: (places among them, sizes, ids in a row) per part."""
        starts, sizes, flats, end = np.zeros(n, np.int64), np.zeros(n, np.int64), [self.flat], len(self.flat)
        for at, size, flat in parts:
            starts[at], sizes[at] = end + np.cumsum(size) - size, size
            flats.append(flat.astype(np.int32))
            end += len(flat)
        self.starts, self.sizes = np.append(self.starts, starts), np.append(self.sizes, sizes)
        self.flat = np.concatenate(flats)


class Encoder:
    """One per Python worker: lexicon first, exact merge for the rest, a bounded memory.

    The memory is kept in two generations: when the young one is full it becomes the old
    one, and what a block still needs moves over, so pieces in use are never learnt twice in a
    row.  A piece is looked up once per occurrence; its ids are gathered by arrays.
    """

    def __init__(self, path: str, block: bytes):
        self.bpe, self.lexicon = WordBpe(path), Lexicon(block)
        self.young, self.old = Memory(), Memory().close()
        top = max(self.bpe.names, default=-1) + 1
        self.digits = [b"%d" % i for i in range(top)]
        self.tokens = [self.bpe.names.get(i, "").encode() for i in range(top)]

    @classmethod
    def of(cls, name: str, path: str, block) -> "Encoder":
        return held(name, lambda: cls(path, block.value))

    def learn(self, pieces: list[str]) -> None:
        old, lexicon, special = self.old, self.lexicon, self.bpe.special
        seen = np.fromiter((old.number.get(p, -1) for p in pieces), np.int64, len(pieces))
        at = np.flatnonzero(seen >= 0)
        sizes = old.sizes[seen[at]]
        parts = [(at, sizes, gather(old.flat, old.starts[seen[at]], sizes))]
        at = np.flatnonzero(seen < 0)
        raw = [pieces[i].encode("utf-8", "replace") for i in at]
        found = lexicon.find(raw)
        known, word = at[found >= 0], found[found >= 0]
        starts = lexicon.starts[word].astype(np.int64)
        sizes = lexicon.starts[word + 1] - starts
        parts.append((known, sizes, gather(lexicon.flat, starts, sizes)))
        rest = [(i, r) for i, r, f in zip(at.tolist(), raw, found.tolist()) if f < 0]
        own = [(i, special[pieces[i]]) for i, _ in rest if pieces[i] in special]
        parts.append((np.array([i for i, _ in own], np.int64), np.ones(len(own), np.int64),
                      np.array([k for _, k in own], np.int32)))
        rest = [(i, r) for i, r in rest if pieces[i] not in special]
        place = np.array([i for i, _ in rest], np.int64)
        parts += [(place[k], n, flat) for k, n, flat in self.bpe.merge_all(
            [pieces[i] for i, _ in rest], [r for _, r in rest])]
        self.young.add(len(pieces), parts)

    def encode_all(self, texts):
        """The ids of each text; new pieces of some texts are learnt together."""
        block: list[str] = []
        ends: list[int] = []
        for t in texts:
            if t:
                block += self.bpe.pieces(t)
            ends.append(len(block))
            if len(block) > BLOCK_PIECES:
                yield from self.encode_block(block, ends)
                block, ends = [], []
        yield from self.encode_block(block, ends)

    def encode_block(self, pieces: list[str], ends: list[int]) -> list[np.ndarray]:
        if len(self.young.number) > CACHE_ROWS:
            self.old, self.young = self.young.close(), Memory()
        number = self.young.number
        known = len(number)
        rows = np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
        new = list(islice(reversed(number), len(number) - known))[::-1]
        if new:
            self.learn(new)
        sizes = self.young.sizes[rows]
        flat = gather(self.young.flat, self.young.starts[rows], sizes)
        total = np.concatenate(([0], np.cumsum(sizes)))
        at = [0, *total[np.array(ends, np.int64)].tolist()]
        return [flat[a:b] for a, b in zip(at, at[1:])]

    def texts(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """Decimal ids joined by one space; the decoded text."""
        ids = ids.tolist()
        return (b" ".join(map(self.digits.__getitem__, ids)), b" ".join(map(self.tokens.__getitem__, ids)))


def strings(texts: pa.Array):
    """Values of an Arrow column, BATCH_TEXTS turned into Python strings at a time."""
    for k in range(0, len(texts), BATCH_TEXTS):
        yield from texts.slice(k, BATCH_TEXTS).to_pylist()


def list_array(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    if ends[-1] > np.iinfo(np.int32).max:
        raise ValueError("a batch holds more token ids than an Arrow list can; lower "
                         "spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
        np.concatenate(rows) if rows else np.empty(0, np.int32), pa.int32()))


def piece_counts(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """(piece, n) over all documents: counted per task, then summed."""
    def count(batches):
        release()
        bpe = WordBpe(path)
        seen: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                if text:
                    seen.update(bpe.pieces(text))
                    if len(seen) > COUNTER_ROWS:
                        yield pd.DataFrame({"piece": list(seen), "n": list(seen.values())})
                        seen.clear()
                        bpe.split_chunks.clear()
        yield pd.DataFrame({"piece": pd.Series(list(seen), dtype=object),
                            "n": pd.Series(list(seen.values()), dtype="int64")})

    return (docs.select(F.col(text_col).cast("string").alias("text"))
            .mapInPandas(count, "piece string, n long")
            .groupBy("piece").agg(F.sum("n").alias("n")))


class Codec:
    """Encoding and decoding columns over one lexicon, built from ``docs``."""

    def __init__(self, docs: DataFrame, text_col: str = "text", path: str | None = None,
                 lexicon: int = LEXICON):
        self.path = path or default_path()
        bpe = WordBpe(self.path)
        # a top-k report: the bound is the operator's parameter
        counts = cut(piece_counts(docs, self.path, text_col).where(
            (F.octet_length("piece") <= LONGEST) & ~F.col("piece").isin(*bpe.special)), "bpe-counts")
        words = [p for p, _ in most_frequent(counts, "piece", lexicon)]
        raw = [p.encode() for p in words]
        entries = {}
        for at, n, flat in bpe.merge_all(words, raw):
            end = np.cumsum(n).tolist()
            flat = flat.tolist()
            entries.update((raw[i], flat[a:b]) for i, a, b in zip(at.tolist(), [0, *end], end))
        self.name = uuid.uuid4().hex
        self.block = docs.sparkSession.sparkContext.broadcast(compile_lexicon(entries))

    def encode(self):
        """Column function: text -> array of token ids."""
        name, path, block = self.name, self.path, self.block

        @F.arrow_udf("array<int>")
        def ids(texts: pa.Array) -> pa.Array:
            return list_array(list(Encoder.of(name, path, block).encode_all(strings(texts))))
        return ids

    def decode(self):
        """Column function: array of token ids -> the tokenizer's decoded text."""
        name, path, block = self.name, self.path, self.block

        @F.pandas_udf("string")
        def text(rows: pd.Series) -> pd.Series:
            names = Encoder.of(name, path, block).bpe.names
            return pd.Series([None if r is None else
                              " ".join(names[int(i)] for i in r if int(i) in names) for r in rows])
        return text

    def digest(self, with_ids: bool = False):
        """Column function: text -> struct(n_tokens, ids_sha256, decoded_sha256[, ids]).

        The digests are of the id list and of the decoded text that
        ``encode`` and ``decode`` give.
        """
        name, path, block = self.name, self.path, self.block

        def digests(texts: pa.Array) -> pa.Array:
            enc = Encoder.of(name, path, block)
            n, sha, decoded, kept = [], [], [], []
            for ids in enc.encode_all(strings(texts)):
                n.append(len(ids))
                for out, text in zip((sha, decoded), enc.texts(ids)):
                    out.append(hashlib.sha256(text).hexdigest())
                if with_ids:
                    kept.append(ids)
            columns = [pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(decoded, pa.string())]
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]
            if with_ids:
                columns.append(list_array(kept))
            return pa.StructArray.from_arrays(columns, names=names[:len(columns)])

        kind = "n_tokens long, ids_sha256 string, decoded_sha256 string"
        return F.arrow_udf(digests, kind + (", ids array<int>" if with_ids else ""))


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            path: str | None = None, lexicon: int = LEXICON) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256."""
    codec = Codec(docs, text_col, path, lexicon)
    return (docs.select(F.col(id_col), codec.digest()(F.col(text_col).cast("string")).alias("e"))
            .select(id_col, "e.n_tokens", "e.ids_sha256", "e.decoded_sha256"))


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document encoded and decoded."""
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage (the last): doc_id, token ids, their number and digests of what was kept."""
    codec = Codec(docs)
    return (docs.select("doc_id", codec.digest(with_ids=True)(F.col("text").cast("string")).alias("e"))
            .select("doc_id", "e.ids", "e.n_tokens", "e.ids_sha256", "e.decoded_sha256"))
