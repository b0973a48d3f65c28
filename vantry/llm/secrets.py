"""Secrets in texts: fixed patterns, and values whose guess cost is high.

Base spans are those of three patterns (assign, access, hex). The method adds spans of kind
`guess`: values in credential contexts that no cheap guess covers. Contexts are the assign pattern, whose
value is group 2, and further words (such as passphrase or credential) before `:`, `=` or `is`. The guess
cost of a value is the least sum, over all ways to cut it up, of the log2 cost of its parts: words by their
rank in a dictionary, dates, repeats, keyboard walks, and brute-force spans by the kinds of their
characters. It is found by dynamic programming over the ends of the parts, and it alone decides: values
have any length and any characters. So `password=changeme` has an assign span alone, and a random
password a guess span beside it. A guess span of a further context that lies inside a base span is left out.

Positions are code points, end exclusive. Null texts count as empty and have no spans. Whole
texts are searched; the work is a narrow map without any shuffle. Repeated rows give repeated
rows; null keys are kept; other columns, whatever their names, are not carried. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantry.llm.chunks import slices
from vantry.llm.scratch import small_batches

# The base patterns by kind, and the least lengths of a value and of an access key.
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "guess")
# Further words that announce a credential.
CONTEXT = re.compile(r"""(?:pwd|pass-?phrase|pass-?code|pin[ _-]?code|credentials?|private[_-]?key|access[_-]?key|auth[_-]?key|client[_-]?id|bearer)["']?\s{0,3}(?::|=|\bis\b)?\s{0,3}["']?([!-~]{6,})""", re.IGNORECASE)
CONTEXT_HINTS = ("pwd", "pass", "pin", "credential", "key", "client", "bearer")
# Rows of a keyboard.
ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "qwertzuiop", "azertyuiop")
DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d|(?:19|20)\d\d")

GUESS_BITS = 45.0  # values that cost at least so many bits are reported
PART_MOST = 64  # characters of a repeat or walk; a longer one is several parts

_NEXT: dict[str, set[str]] = {}
for _row in ROWS:
    for _a, _b in zip(_row, _row[1:], strict=False):
        _NEXT.setdefault(_a, set()).add(_b)
        _NEXT.setdefault(_b, set()).add(_a)


class Dictionary(dict):
    """Lower-case words by rank, and the length of the longest."""

    longest = 0


def _brute_bits(char: str) -> float:
    return math.log2(10 if char.isdigit() else 26 if char.isascii() and char.isalpha() else 33 if char.isascii() else 1000)


def guess_bits(value: str, words: dict[str, int]) -> float:
    """log2 of the guesses for the cheapest segmentation of value; words: lower-case words by rank."""
    low, n = "".join(c.lower() if len(c.lower()) == 1 else c for c in value), len(value)
    longest = min(n, words.longest if isinstance(words, Dictionary) else max(map(len, words), default=0))
    best = [0.0] + [math.inf] * n
    dates: dict[int, list[int]] = {}
    for at in range(n):
        if value[at].isdigit() and (m := DATE.match(value, at)):
            dates.setdefault(m.end(), []).append(at)
    run = walk = 1  # lengths of the repeat and of the walk that end here
    for end in range(1, n + 1):
        cost = best[end - 1] + _brute_bits(value[end - 1])
        for start in range(max(0, end - longest), end - 2):
            rank = words.get(low[start:end])
            if rank is not None:
                upper = sum(1 for c in value[start:end] if c.isupper())
                case = 0.0 if not upper else 1.0 if upper == end - start or (upper == 1 and value[start].isupper()) else 1.0 + upper
                cost = min(cost, best[start] + math.log2(rank + 2) + case)
        for start in dates.get(end, ()):
            cost = min(cost, best[start] + math.log2(365 * 120 if end - start > 4 else 120))
        if end > 1:
            run = run + 1 if low[end - 1] == low[end - 2] else 1
            walk = walk + 1 if low[end - 1] in _NEXT.get(low[end - 2], ()) else 1
        if run >= 3:
            cost = min(cost, *(best[end - k] + _brute_bits(value[end - 1]) + math.log2(k) for k in range(3, min(run, PART_MOST) + 1)))
        if walk >= 3:
            cost = min(cost, *(best[end - k] + math.log2(94) + (k - 1) * 1.0 for k in range(3, min(walk, PART_MOST) + 1)))
        for unit in (2, 3, 4):  # a repeat of a longer unit
            if end >= 2 * unit and low[end - unit : end] == low[end - 2 * unit : end - unit]:
                cost = min(cost, best[end - unit] + 2.0)
        best[end] = cost
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, ordered."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def guess_spans(text: str, words: dict[str, int], least: float = GUESS_BITS) -> list[tuple[int, int, int]]:
    """Values in further credential contexts that cost at least so many bits."""
    low = text.lower()
    if not any(hint in low for hint in CONTEXT_HINTS):
        return []
    out = []
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip("\"').,;")
        if guess_bits(value, words) >= least:
            out.append((m.start(1), 3, m.start(1) + len(value)))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def dictionary(rank_file: str, least: int = 3) -> dict[str, int]:
    """Words of a rank file of a byte-level vocabulary, by the order of their ranks: frequent words come first."""
    import base64

    tokens = []
    with open(rank_file, "rb") as lines:
        for token, rank in map(bytes.split, lines):
            word = base64.b64decode(token).decode("utf-8", "replace").strip().lower()
            if len(word) >= least and word.isalpha():
                tokens.append((int(rank), word))
    out = Dictionary()
    for _, word in sorted(tokens):
        out.setdefault(word, len(out))
    out.longest = max(map(len, out), default=0)
    return out


def scan(docs: DataFrame, rank_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_assign, n_access, n_hex, n_guess (long), base, spans (strings kind:start:end, comma-joined), bits
    (the guess cost of each assign value, in order). `rank_file` gives the dictionary; the driver reads it."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(dictionary(rank_file))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                base, spans, counts, bits = [], [], [[], [], [], []], []
                for value in part.column(1).to_pylist():
                    found = base_spans(value)
                    costs, guessed = [], set()
                    for start, kind, _ in found:
                        if kind == 0:
                            m = ASSIGN.match(value, start)
                            costs.append(round(guess_bits(m[2], words), 3))
                            if costs[-1] >= GUESS_BITS:
                                guessed.add((m.start(2), 3, m.end(2)))
                    guessed |= {g for g in guess_spans(value, words) if not any(s <= g[0] and g[2] <= e for s, _, e in found)}
                    more = sorted([*found, *guessed])
                    base.append(joined(found))
                    spans.append(joined(more))
                    for kind in range(4):
                        counts[kind].append(sum(1 for x in more if x[1] == kind))
                    bits.append(costs)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(spans, pa.string()), pa.array(bits, pa.list_(pa.float64()))],
                    ["key", "n_assign", "n_access", "n_hex", "n_guess", "base", "spans", "bits"],
                )

    out = rows.mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, n_assign long, n_access long, n_hex long, n_guess long, base string, spans string, bits array<double>")
    return out.withColumnRenamed("key", key)
