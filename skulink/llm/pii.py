"""Personal data: base patterns plus candidate gradient boosting (operator 1).

Base spans are exact patterns (email, ip, card, phone; leftmost and
non-overlapping per kind, checks failing drop a match without retry).

The method adds spans of further kinds.  Generators of high recall propose
overlapping candidates (secrets, phone-like and id-like numbers, bank
accounts, spelled-out addresses, IPv6).  Boosted trees judge each candidate by
its format (lengths, character classes, entropy, check sums) and context (cue
words before it, quotes, assignment).  The trees' scores are calibrated by
Platt scaling on held-out examples, and per kind the lowest probability that
reaches PRECISION there is the threshold.  Selected candidates that overlap
a base span or a better candidate go.

No labelled spans exist in the tables, so the trees learn from examples that
:func:`examples` writes from a seed: true formats in true contexts and hard
negatives (dates, versions, ISBNs, slugs, checksums, times).  The model is a few
kilobytes, the same at every size, and is shipped with the tasks' closure.
Finding is one scan without a shuffle.

Defined results: null text is empty (no spans); spans are code points, end
exclusive; repeated rows give equal rows; an empty table gives no rows;
other columns are ignored.  Texts of any length are read whole; every
pattern runs in linear time.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skulink.llm.common import fresh

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "phone_like", "id_number", "account", "email_like", "ipv6")
KINDS = BASE_KINDS + ADDED_KINDS
ORDER = {k: i for i, k in enumerate(KINDS)}
PRECISION = 0.98
TREES, DEPTH, RATE, BINS = 40, 3, 0.2, 24

# base patterns (fixed values); a look-behind keeps digit runs from being tried at every digit
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

GENERATORS = {
    "secret": re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}+={0,2}"),
    "phone_like": re.compile(r"(?<![0-9A-Za-z.,/+-])\(?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,14}(?![0-9])"),
    "id_number": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "account": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "email_like": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\)|\{at\}|\x20at)\x20[A-Za-z0-9-]{1,63}"
        r"(?:\x20?(?:\[dot\]|\(dot\)|\{dot\}|\x20dot)\x20?[A-Za-z0-9-]{1,63}|\.[A-Za-z0-9-]{1,63}){1,4}", re.I),
    "ipv6": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}(?![0-9A-Fa-f:])"),
}
#: ends of spelled-out addresses that sentences rarely have
MAIL_END = re.compile(r"(?:\.|dot[\])}]?\x20?)(?:com|org|net|edu|gov|io|de|uk)$", re.I)
CUES = {
    "secret_cue": ("token", "key", "secret", "passw", "auth", "bearer", "credential"),
    "phone_cue": ("phone", "tel", "call", "fax", "mobile", "ring"),
    "id_cue": ("ssn", "social", "passport", "security no", "tax id"),
    "account_cue": ("iban", "account", "bank", "transfer"),
    "mail_cue": ("mail", "contact", "write to", "reach"),
    "host_cue": ("ipv6", "host", "address", "server", "ping"),
    "other_cue": ("version", "isbn", "page", "order", "commit", "sha", "checksum", "date", "part",
                  "price", "ratio", "chapter", "section", "score", "time", "md5", "look", "meet"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(DIGIT.findall(s))


def emails(text: str):
    """Leftmost non-overlapping email spans, found from each @ outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at)
        if m:
            start = at
            while start > done and text[start - 1] in LOCAL_CHARS:
                start -= 1
            if start < at:
                yield start, m.end()
                done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds, by start, then kind as listed."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m.groups()]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            d = only_digits(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(only_digits(m[0])) <= 15:
                    out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], ORDER[s[0]]))


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping proposals of the generators."""
    out = []
    digits = DIGIT.search(text) is not None
    for kind, pattern in GENERATORS.items():
        # only what every match of the pattern holds may rule it out
        if kind == "email_like":
            low = text.lower()
            if not any(at in low for at in ("[at] ", "(at) ", "{at} ", " at ")):
                continue
        elif kind == "ipv6":
            if text.count(":") < 3:
                continue
        elif kind != "secret" and not digits:
            continue
        out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return out


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    s, before, after = text[start:end], text[max(0, start - 32):start], text[end:end + 2]
    n = len(s)
    digits, upper = sum(c.isdigit() for c in s), sum(c.isupper() for c in s)
    lower = sum(c.islower() for c in s)
    counts = [s.count(c) for c in set(s)]
    entropy = -sum(c / n * math.log2(c / n) for c in counts)
    near = before.lower()
    switches = sum(a.isdigit() != b.isdigit() for a, b in zip(s, s[1:]))
    groups = re.split(r"[^0-9A-Za-z]+", s)
    d = only_digits(s)
    return [*[float(kind == k) for k in ADDED_KINDS], n, digits, upper, lower, digits / n,
            n - digits - upper - lower, entropy, switches / n, len(groups),
            max(map(len, groups)), float(all(c in "0123456789abcdefABCDEF" for c in s)),
            float(len(d) >= 12 and luhn(d)), float(kind == "account" and iban_ok(s)),
            float(bool(re.match(r"(?:19|20)[0-9]{2}\D", s))), s.count("."), s.count(":"),
            s.count("-"), s.count("/"), float("(" in s), float(s[0] in "0("),
            float("dot" in s.lower()), float(bool(MAIL_END.search(s))), float("[" in s or "{" in s), float("::" in s),
            float(before[-1:] in ("\"", "'")), float(after[:1] in ("\"", "'")),
            float(bool(re.search(r"[=:]\s*[\"']?$", before))),
            *[float(any(c in near for c in cues)) for cues in CUES.values()]]


# ------------------------------------------------------------------ examples

def examples(seed: int, n: int = 6000) -> list[tuple[str, str, int, int, bool]]:
    """(text, kind, start, end, personal): candidates in written examples."""
    r = random.Random(seed)
    dig = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    pick = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    hexa, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    word = lambda: pick("etaoinshrdlu", r.randint(2, 9))

    def iban(valid: bool) -> str:
        body = pick("0123456789", r.choice((14, 16, 18, 20)))
        land = r.choice(("DE", "FR", "ES", "GB", "NL"))
        check = 98 - int("".join(str(int(c, 36)) for c in body + land + "00")) % 97
        if not valid:
            check = (check + r.randint(1, 90)) % 97 + 2
        s = f"{land}{check:02d}{body}"
        if not valid and iban_ok(s):
            s = s[:-1] + str((int(s[-1]) + 1) % 10)
        return " ".join(s[i:i + 4] for i in range(0, len(s), 4)) if r.random() < 0.5 else s

    def secret() -> str:
        return r.choice((lambda: pick(hexa, r.choice((32, 40, 64))), lambda: pick(hexa, 40).upper(),
                         lambda: pick(alnum, r.randint(20, 44)), lambda: "AKIA" + pick(alnum.upper(), 16),
                         lambda: "ghp_" + pick(alnum, 36), lambda: "sk-" + pick(alnum, 40)))()

    def phone() -> str:
        a, b, c = dig(3), dig(3), dig(4)
        return r.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{dig(2)}/{dig(7)}",
                         f"00{dig(2)} {dig(2)} {dig(7)}", f"0{dig(3)} {dig(3)} {dig(3)}"))

    def date() -> str:
        y, m, d = r.randint(1900, 2030), r.randint(1, 12), r.randint(1, 28)
        return r.choice((f"{y}-{m:02d}-{d:02d}", f"{d:02d}.{m:02d}.{y}", f"{y}/{m:02d}/{d:02d}"))

    v6 = lambda: r.choice((":".join(pick(hexa, 4) for _ in range(8)),
                           "fe80::" + ":".join(pick(hexa, 4) for _ in range(4)),
                           "2001:db8:" + pick(hexa, 4) + "::" + pick(hexa, 2)))
    spelled = lambda: r.choice((
        f"{word()}.{word()} [at] {word()} [dot] com", f"{word()} (at) {word()}.org",
        f"{word()} at {word()} dot com", f"{word()}{dig(2)} [at] {word()}.net",
        f"{word()} at {word()} [dot] {r.choice(('com', 'org', 'net'))}"))
    letters = lambda: r.choice((
        lambda: pick(alnum[:52], r.randint(20, 44)), lambda: pick(alnum[26:52], r.randint(20, 40))))()
    v6_letters = lambda: r.choice((":".join(pick("abcdef", 4) for _ in range(8)),
                                   "fe" + pick("abcdef", 2) + "::" + ":".join(pick("abcdef", 4) for _ in range(4))))
    #: (kind, personal, value, contexts)
    kinds = [
        ("secret", True, secret, ('token = "{}"', "api_key: {}", "password={}", "Bearer {}", "{}",
                                  "secret '{}'", 'key = "{}"')),
        ("secret", True, letters, ('token = "{}"', "api_key: {}", "password={}", "Bearer {}", "secret '{}'")),
        ("secret", False, lambda: r.choice(("-", "_", "/")).join(word() for _ in range(5)) + word() * 2,
         ("{}", "see {}", "file {}", "the {}")),
        ("secret", False, lambda: pick("etaoinsrhl", r.randint(16, 30)), ("{}", "the {}", "see {}")),
        ("secret", False, lambda: "".join(word().capitalize() for _ in range(5)), ("{}", "the {}", "class {}")),
        ("secret", False, lambda: r.choice("=-_") * r.randint(16, 60), ("{}", "key {}")),
        ("secret", False, lambda: "-".join(word() for _ in range(5)) + "-" + dig(4), ("{}", "see {}")),
        ("secret", False, lambda: pick("etaoinsrhl", r.randint(16, 30)) + dig(r.choice((1, 2, 4))),
         ("{}", "the {}")),
        ("secret", False, lambda: pick(hexa, r.choice((32, 40, 64))),
         ("commit {}", "sha256 {}", "checksum: {}", "md5 {}")),
        ("secret", False, lambda: r.choice("=-_") * r.randint(15, 40) + dig(1), ("{}",)),
        ("secret", False, lambda: dig(r.randint(16, 24)), ("{}", "no. {}", "number {}")),
        ("secret", False, lambda: "/".join(word() for _ in range(4)) + "/" + date(), ("{}", "file {}")),
        ("phone_like", True, phone, ("phone {}", "call {}", "tel: {}", "fax {}", "mobile {}", "Tel. {}")),
        ("phone_like", False, phone, ("order {}", "part {}", "score {}")),
        ("phone_like", False, date, ("{}", "on {}", "date {}", "of {}")),
        ("phone_like", False, lambda: f"978-{dig(1)}-{dig(2)}-{dig(6)}-{dig(1)}", ("ISBN {}", "{}")),
        ("phone_like", False, lambda: dig(r.randint(8, 16)), ("{}", "number {}", "the {}")),
        ("phone_like", False, lambda: " ".join(dig(1) for _ in range(r.randint(8, 12))), ("{}",)),
        ("phone_like", False, lambda: ".".join(dig(2) for _ in range(5)), ("version {}", "{}")),
        ("id_number", True, lambda: f"{dig(3)}-{dig(2)}-{dig(4)}",
         ("SSN {}", "social security {}", "ssn: {}", "tax id {}")),
        ("id_number", False, lambda: f"{dig(3)}-{dig(2)}-{dig(4)}", ("order {}", "part {}", "section {}", "{}")),
        ("account", True, lambda: iban(True), ("IBAN {}", "account {}", "{}", "transfer to {}")),
        ("account", False, lambda: iban(False), ("{}", "code {}", "part {}")),
        ("email_like", True, spelled, ("mail {}", "contact {}", "write to {}", "{}", "reach me: {}")),
        ("email_like", False, lambda: f"{word()} at {word()} dot {word()}",
         ("look {}", "meet {}", "page {}")),
        ("email_like", True, lambda: f"{word()} at {word()}.{r.choice(('com', 'org', 'net'))}",
         ("mail {}", "contact {}", "write to {}", "reach me: {}")),
        ("email_like", False, lambda: f"{word()} at {word()}.{r.choice(('com', 'org', 'net', word()))}",
         ("look {}", "meet {}", "page {}", "{}")),
        ("email_like", False, lambda: f"{word()} at {word()}.{word()}", ("{}", "the {}", "contact {}")),
        ("ipv6", True, v6_letters, ("host {}", "{}", "address {}", "server {}")),
        ("ipv6", False, lambda: ":".join(pick("abcdef", r.randint(0, 2)) for _ in range(r.randint(4, 8))),
         ("{}", "ratio {}", "the {}")),
        ("ipv6", True, v6, ("host {}", "{}", "address {}", "server {}")),
        ("ipv6", False, lambda: ":".join(dig(2) for _ in range(r.choice((4, 5)))),
         ("time {}", "ratio {}", "{}", "score {}")),
    ]
    out = []
    for _ in range(n):
        kind, personal, value, contexts = r.choice(kinds)
        s, context = value(), r.choice(contexts)
        left, right = context.split("{}")
        head = " ".join(word() for _ in range(r.randint(0, 6))) + r.choice((" ", ". ", ", "))
        text = head + left + s + right + r.choice((" ", ". ", ", ")) + " ".join(word() for _ in range(3))
        a = len(head) + len(left)
        for k, x, y in candidates(text):
            inside = min(y, a + len(s)) - max(x, a)
            same = inside > 0 and inside >= 0.9 * max(y - x, len(s))
            if inside > 0:
                # another kind's proposal over a personal span is neither right nor wrong
                if k == kind or not personal:
                    out.append((text, k, x, y, personal and same))
    return out


# --------------------------------------------------------------------- trees

class Trees:
    """Boosted regression trees on binned features, Newton steps on log loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cuts = [self.edges(np.unique(c)) for c in x.T]
        b = self.binned(x)
        rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.base, self.trees = math.log(rate / (1 - rate)), []
        f = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            node, leaves = self.grow(b, p - y, p * (1 - p))
            self.trees.append(node)
            f += leaves

    @staticmethod
    def edges(values: np.ndarray) -> np.ndarray:
        """Bin edges: between all values of few, at quantiles of many."""
        if len(values) <= BINS:
            return (values[1:] + values[:-1]) / 2
        return np.unique(np.quantile(values, np.linspace(0, 1, BINS + 1)[1:-1]))

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, "right") for c, v in zip(self.cuts, x.T)], 1)

    def grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray):
        """Complete tree of DEPTH levels: (feature, bin) per inner node, values per leaf."""
        at = np.zeros(len(g), np.int64)
        splits = []
        for level in range(DEPTH):
            n = 2 ** level
            best = [(-1.0, 0, BINS)] * n
            for j in range(b.shape[1]):
                hist = np.zeros((2, n, BINS))
                for k, w in enumerate((g, h)):
                    hist[k] = np.bincount(at * BINS + b[:, j], w, n * BINS).reshape(n, BINS)
                gl, hl = hist[0].cumsum(1), hist[1].cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
                for q in range(n):
                    k = int(gain[q].argmax())
                    if gain[q, k] > best[q][0]:
                        best[q] = (float(gain[q, k]), j, k)
            splits.append([(j, k) for _, j, k in best])
            f, k = (np.array([s[i] for s in splits[-1]]) for i in (0, 1))
            at = at * 2 + (b[np.arange(len(at)), f[at]] > k[at])
        n = 2 ** DEPTH
        leaf = -RATE * np.bincount(at, g, n) / (np.bincount(at, h, n) + 1)
        return (splits, leaf), leaf[at]

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        f = np.full(len(b), self.base)
        rows = np.arange(len(b))
        for splits, leaf in self.trees:
            at = np.zeros(len(b), np.int64)
            for level in splits:
                j, k = (np.array([s[i] for s in level]) for i in (0, 1))
                at = at * 2 + (b[rows, j[at]] > k[at])
            f += leaf[at]
        return f


class Model:
    """Trees, Platt calibration and one threshold per kind."""

    def __init__(self, seed: int = 20):
        train, held = examples(seed), examples(seed + 1, 3000)
        x, y = self.table(train)
        self.trees = Trees(x, y)
        hx, hy = self.table(held)
        s = self.trees.score(hx)
        a, b = 1.0, 0.0
        for _ in range(25):                       # Newton steps of a two-weight logistic fit
            p = 1 / (1 + np.exp(-(a * s + b)))
            w = p * (1 - p) + 1e-9
            g = np.array([((p - hy) * s).sum(), (p - hy).sum()])
            hess = np.array([[(w * s * s).sum(), (w * s).sum()], [(w * s).sum(), w.sum()]])
            a, b = np.array([a, b]) - np.linalg.solve(hess + 1e-6 * np.eye(2), g)
        self.a, self.b = float(a), float(b)
        p = 1 / (1 + np.exp(-(a * s + b)))
        kinds = np.array([e[1] for e in held])
        self.thresholds = {}
        for k in ADDED_KINDS:
            q, t = p[kinds == k], hy[kinds == k]
            order = np.argsort(-q)
            good = np.cumsum(t[order]) / np.arange(1, len(t) + 1) >= PRECISION
            last = np.flatnonzero(good)
            self.thresholds[k] = float(max(0.5, q[order][last[-1]])) if len(last) else 2.0

    @staticmethod
    def table(rows) -> tuple[np.ndarray, np.ndarray]:
        x = np.array([features(t, k, a, b) for t, k, a, b, _ in rows], np.float64)
        return x, np.array([float(r[4]) for r in rows])

    def probability(self, text: str, cands: list[tuple[str, int, int]]) -> np.ndarray:
        x = np.array([features(text, *c) for c in cands], np.float64)
        return 1 / (1 + np.exp(-(self.a * self.trees.score(x) + self.b)))

    def spans(self, text: str) -> list[tuple[str, int, int, float]]:
        """All spans: base ones with probability 1, selected ones with theirs."""
        base = base_spans(text)
        out = [(*s, 1.0) for s in base]
        cands = candidates(text)
        # what touches a base span cannot be selected: no need to score it
        if base and cands:
            cands = disjoint(cands, base)
        if cands:
            p = self.probability(text, cands)
            picked = [(float(-q), c) for q, c in zip(p, cands) if q >= self.thresholds[c[0]]]
            taken: list[tuple[int, int]] = []        # selected spans, by start
            for q, (k, a, b) in sorted(picked, key=lambda x: (x[0], x[1][1], ORDER[x[1][0]])):
                i = bisect_left(taken, (a, b))
                if (i == 0 or taken[i - 1][1] <= a) and (i == len(taken) or b <= taken[i][0]):
                    taken.insert(i, (a, b))
                    out.append((k, a, b, -q))
        return sorted(out, key=lambda s: (s[1], ORDER[s[0]]))


def disjoint(cands, base):
    """Candidates that touch no base span, by one merge over sorted spans."""
    starts = np.array([b[1] for b in base])
    ends = np.maximum.accumulate(np.array([b[2] for b in base]))
    keep = []
    for c in cands:
        i = int(np.searchsorted(starts, c[2], "left"))   # base spans starting before c ends
        if i == 0 or ends[i - 1] <= c[1]:
            keep.append(c)
    return keep


@lru_cache(maxsize=1)
def model() -> Model:
    """The fitted model (seconds to fit; deterministic)."""
    return Model()


SPANS = "array<struct<kind:string,start:int,end:int,p:double>>"


def finder(shared):
    """Column function: text -> all spans, by start, then kind as listed."""
    @F.pandas_udf(SPANS)
    def find(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([[dict(zip(("kind", "start", "end", "p"), s)) for s in m.spans(t)]
                          if t else [] for t in texts])
    return find


def redacted(text: str | None, spans) -> str | None:
    """Every span replaced by its kind in brackets; overlapping spans become one."""
    if text is None or not len(spans):
        return text
    parts, pos = [], 0
    for s in spans:
        if s["start"] >= pos:
            parts += [text[pos:s["start"]], f"[{s['kind'].upper()}]"]
        pos = max(pos, s["end"])
    return "".join(parts) + text[pos:]


def redactor(shared):
    """Column function: text -> struct(n, text): number of spans, text without them."""
    @F.pandas_udf("n long, text string")
    def redact(texts: pd.Series) -> pd.DataFrame:
        m, out = shared.value, []
        for t in texts:
            spans = [dict(zip(("kind", "start", "end", "p"), s)) for s in m.spans(t)] if t else []
            out.append((len(spans), redacted(t, spans)))
        return pd.DataFrame(out, columns=["n", "text"])
    return redact


def with_spans(docs: DataFrame, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """``docs`` with an array of struct kind, start, end, p (1 for base spans)."""
    shared = docs.sparkSession.sparkContext.broadcast(model())
    return docs.withColumn(out_col, finder(shared)(F.col(text_col).cast("string")))


def joined_spans(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Contract query: personal data of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = with_spans(docs)
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return out.select("doc_id", *[of_kind(k).alias(f"n_{k}") for k in BASE_KINDS],
                      F.sha2(joined_spans(base), 256).alias("base_sha256"),
                      joined_spans(F.col("spans")).alias("spans"),
                      F.size("spans").cast("long").alias("n_spans"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all spans are redacted; other texts stay unchanged."""
    out = fresh(docs, "_redacted")
    shared = docs.sparkSession.sparkContext.broadcast(model())
    new = {"text": F.col(f"{out}.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(
            F.col(f"{out}.n") > 0, F.char_length(f"{out}.text").cast(docs.schema["n_chars"].dataType)
        ).otherwise(F.col("n_chars"))
    return docs.withColumn(out, redactor(shared)(F.col("text").cast("string"))).select(
        *[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
