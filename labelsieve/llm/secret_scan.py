"""Secret scan: fixed patterns, and the guess cost of values that stand where a credential would.

Base kinds, each searched leftmost and without overlap, then filtered by length:
``assign`` (a credential name, ``:`` or ``=``, a value of 12+ characters), ``access``
(``AKIA...``, 18+), ``hex`` (16+ lower-case hex digits).

``password`` is the method's own kind.  A value in credential context is split into
the cheapest sequence of words, dates, repeats, keyboard walks and brute-force spans
by dynamic programming over its positions; the cost is the decimal logarithm of the
guesses an attacker needs.  A value that costs ``MIN_COST`` or more is a secret,
a cheaper one (``changeme``, ``qwerty123``) a placeholder.  A value inside a
base span is not reported twice.

A value behind an opening quote ends at its closing quote on the same line (escaped
quotes belong to it, and blanks); without one it is the whole run of visible ASCII
characters, less closing punctuation.  Values have any length: the dynamic programme
leaves out only states and segments that cost ``MIN_COST`` by themselves, and stops
where none below it can be continued, so the decision is that of the full programme.

The words are ranked by how early a guesser tries them: a short fixed list, then whatever
comes first in a public tokenizer's vocabulary (common subwords first) or in the corpus itself
(words by the number of documents that hold them, one Spark count over all texts).  The
list is bounded (``LEARNT_WORDS`` from each source) and broadcast.

Positions are code points, ends exclusive.  One pass over the texts in tasks, no
shuffle of texts.  Texts are searched whole, in time that grows with their length.

Defined results: a null or empty text has no span; counts are 0 and the base digest
is that of the empty string; rows that repeat are scanned each, with equal results; an empty
table gives an empty table, and the fixed list and the vocabulary alone as words.
"""

from __future__ import annotations

import base64
import math
import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, docs_of, materialize, slices

# The patterns and lengths of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run shorter than 16 would be dropped anyway
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16

KINDS = ("assign", "access", "hex", "password")
MIN_COST = 10.0
MIN_VALUE = 6
# Name, sign and opening quote of a credential; two quotes before a separator are an empty value.
CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:password|passwd|passphrase|passcode|pass|pwd|secret|token|api[_-]?key|credentials?|login)"""
    r"""["']?[\x20\t]*+(?:is|=>|:=|[:=])[\x20\t]*+(\"{3}|'{3}|(?:""|'')(?![\s,;)\]}>]|\Z)|["'])?""",
    re.IGNORECASE | re.ASCII)
VISIBLE = re.compile(r"[!-~]*+")
NOT_VISIBLE = re.compile(r"[^!-~]")
# The rest of a quoted value and its closing quote.
QUOTED = {q: re.compile(rf"(?:[^{q[0]}\\\r\n]++|\\[^\r\n]|(?!{q}){q[0]})*+{q}") for c in "\"'" for q in (c, c * 2, c * 3)}

# Every match of ASSIGN or CONTEXT holds one of these in lower case.
NAMES = ("pass", "pwd", "secret", "token", "apikey", "api_key", "api-key", "credential", "login")

# Words that guessers try first, commonest first.
WORDS = """password admin welcome letmein login master secret test guest user root changeme default dragon monkey
football baseball shadow sunshine princess iloveyou superman batman hello freedom whatever qwerty trustno1 starwars
computer internet service server database access private public summer winter spring autumn monday friday sunday
january february march april june july august october november december company example sample demo temp token key
the and for you love life blue green black white silver gold""".split()
# Words taken from the vocabulary and from the corpus each, and their length.
LEARNT_WORDS = 50_000
SHORTEST_WORD, LONGEST_WORD = 3, 20
# Parts of the range of document counts (eight to a doubling).
COUNT_STEPS = 8


class Words:
    """Words by their rank, from 1."""

    def __init__(self, words):
        self.rank = {w: i + 1 for i, w in enumerate(dict.fromkeys(words))}
        self.longest = max(map(len, self.rank))


FIXED = Words(WORDS)
LEET = str.maketrans("4301$5@7", "aeoissat")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
DATE = re.compile(r"(?:(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d|(?:19|20)\d\d)")
# Guesses of one brute-force character by its class, of a date, and of starting another segment (logarithms).
BRUTE = {"d": 1.0, "l": math.log10(26), "u": math.log10(26), "s": math.log10(33)}
DATE_COST, YEAR_COST, SEGMENT_COST = math.log10(365.25 * 120 * 4), math.log10(120), math.log10(2)


def _keys() -> dict[str, tuple[float, int]]:
    return {c: (x + row * 0.5, row) for row, line in enumerate(ROWS) for x, c in enumerate(line)}


KEYS = _keys()


def _brute(c: str) -> float:
    return BRUTE["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "s"]


def _adjacent(a: str, b: str) -> bool:
    p, q = KEYS.get(a), KEYS.get(b)
    return p is not None and q is not None and a != b and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def _lower(value: str) -> str:
    """``value`` in lower case, with as many characters."""
    return value.lower() if value.isascii() else "".join(x if len(x := c.lower()) == 1 else c for c in value)


def _cheapest(starts: list[int], best: list[float], j: int, rate: float, fixed: float, limit: float) -> float:
    """Least ``best[i] + log10(rate * (j - i)) + fixed`` of the ascending ``starts``.

    Starts that can never win again leave: the lead of a later start over an earlier
    one only falls as ``j`` grows, and no start gets cheaper.
    """
    least, keep = limit, []
    for i in starts:
        cost = best[i] + fixed + math.log10(rate * (j - i)) + SEGMENT_COST
        if cost < least:
            least = cost
            keep.append(i)
    starts[:] = keep
    return least


def guess_cost(value: str, limit: float = math.inf, words: Words = FIXED) -> float:
    """Decimal logarithm of the guesses for ``value``: the cheapest segmentation; infinite from ``limit`` on."""
    n = len(value)
    low = _lower(value)
    plain = low.translate(LEET)
    brute = [_brute(c) for c in value]
    best = [0.0] + [math.inf] * n
    walk = 0  # start of the keyboard walk that ends at the current character
    walks: list[int] = []  # starts in it
    # A longer unit costs the limit by itself, as every character costs min(BRUTE.values()) at least.
    units = min(n // 2, int(limit / min(BRUTE.values())) if limit < math.inf else n)
    same = [0] * (units + 1)  # characters up to the current one that equal the one a unit before
    repeats: dict[tuple[int, int], list[int]] = {}  # starts of repeats by unit and remainder
    live = 0  # the last position that costs less than the limit
    for j in range(1, n + 1):
        if j > 1 and not _adjacent(low[j - 2], low[j - 1]):
            walk = j - 1
            walks.clear()
        # Brute force: one more character.
        cost = best[j - 1] + brute[j - 1] + (SEGMENT_COST if j == 1 else 0)
        for i in range(max(0, j - words.longest), j - 2):
            rank = words.rank.get(low[i:j])
            leet = 0.0
            if rank is None and (rank := words.rank.get(plain[i:j])) is not None:
                leet = math.log10(2)
            if rank is not None:
                case = 0.0 if value[i:j] == low[i:j] else math.log10(2)
                cost = min(cost, best[i] + math.log10(rank + 1) + case + leet + SEGMENT_COST)
        for i in range(max(0, j - 10), j - 3):
            if value[i].isdigit() and DATE.fullmatch(value, i, j):
                cost = min(cost, best[i] + (YEAR_COST if j - i == 4 else DATE_COST) + SEGMENT_COST)
        reach = max(0, j - words.longest)  # no segment that ends behind j starts before it
        if j - walk >= 3:  # start key, length, turns
            walks.append(j - 3)
            cost = min(cost, _cheapest(walks, best, j, 47 * 4, 0.0, limit))
        reach = min(reach, walk)
        once = 0.0
        for unit in range(1, min(units, j - 1) + 1):  # repeats of a unit that ends at j
            once += brute[j - unit]
            if value[j - 1] != value[j - 1 - unit]:
                if same[unit] >= unit:
                    for r in range(unit):
                        repeats.pop((unit, r), None)
                same[unit] = 0
                continue
            same[unit] += 1
            reach = min(reach, j - unit - same[unit])
            if same[unit] >= unit:
                starts = repeats.setdefault((unit, j % unit), [])
                starts.append(j - 2 * unit)
                cost = min(cost, _cheapest(starts, best, j, 1 / unit, once, limit))
        if cost < limit:
            best[j] = cost
            live = j
        elif live < min(reach, j - 10, j - units):
            return math.inf
    return best[n]


class Runs:
    """Ends of the runs of visible characters; a search that moves forward looks at each run once."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, 0, 0

    def end_from(self, at: int) -> int:
        if not self.start <= at < self.end:
            self.start, self.end = at, VISIBLE.match(self.text, at).end()
        return self.end


def _value(text: str, context: re.Match, runs: Runs) -> tuple[int, int, int]:
    """Start and end of the value behind ``context``, and where the search goes on."""
    start, quote = context.end(), context.group(1)
    closed = QUOTED[quote].match(text, start) if quote else None
    if closed and not text[closed.end():closed.end() + 1].isalnum():
        end = closed.end() - len(quote)
        blank = NOT_VISIBLE.search(text, start, end)
        run = blank.start() if blank else end
    else:
        run = end = runs.end_from(start)
        while end > start and text[end - 1] in "\"',;.)":
            end -= 1
        if closed:  # the quote closes inside a word: the value is the longer of the two
            end = max(end, closed.end() - len(quote))
    # A quoted value may be prose between two others' quotes: names behind its first blank count as well.
    return start, end, min(run, end) if end - start >= MIN_VALUE else start


def spans_of(text: str, words: Words = FIXED) -> list[tuple[int, int, int]]:
    """``(start, kind index, end)`` of every span, sorted."""
    low = text.lower()
    named = any(name in low for name in NAMES)  # else neither ASSIGN nor CONTEXT can match
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= MIN_ASSIGN] if named else []
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    found.sort()
    begins = [f[0] for f in found]
    reach = [0, *accumulate((f[2] for f in found), max)]  # the farthest end of the spans before
    own: list[tuple[int, int, int]] = []
    at, runs = 0, Runs(text)
    while named and (m := CONTEXT.search(text, at)):
        start, end, at = _value(text, m, runs)
        if end - start >= MIN_VALUE and reach[bisect_right(begins, start)] < end \
                and not (own and end <= own[-1][2]) and guess_cost(text[start:end], MIN_COST, words) >= MIN_COST:
            own.append((start, 3, end))
    return sorted(found + own)


def vocabulary_words(path: str, most: int = LEARNT_WORDS) -> list[str]:
    """Words among the tokens of a rank file (base64 token, rank), best rank first."""
    tokens = []
    with open(path, "rb") as file:
        for line in file:
            token, rank = line.split()
            word = base64.b64decode(token).decode("utf-8", "replace").strip().lower()
            if SHORTEST_WORD <= len(word) <= LONGEST_WORD and word.isalpha():
                tokens.append((int(rank), word))
    return list(dict.fromkeys(w for _, w in sorted(tokens)))[:most]


def corpus_words(docs: DataFrame, most: int = LEARNT_WORDS) -> list[str]:
    """At most ``most`` words of ``docs`` (doc_id, text), by falling number of documents that hold them.

    One aggregation over all texts; a step of the counts (an eighth of a doubling) is taken whole or not
    at all, so the words that reach the driver are bounded without ranking all of them.
    """
    word = rf"(?<![\p{{L}}\p{{N}}])\p{{L}}{{{SHORTEST_WORD},{LONGEST_WORD}}}(?![\p{{L}}\p{{N}}])"
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(word), 0))
    counts = docs_of(docs).select(F.explode(found).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts.withColumn("step", F.floor(F.log2("n") * COUNT_STEPS).cast("int")), "word-counts")
    steps = counts.groupBy("step").count().orderBy(F.desc("step")).collect()  # some hundred rows at most
    taken = [s for s, total in zip(steps, accumulate(r["count"] for r in steps), strict=True) if total <= most]
    if not taken:
        return []
    rows = counts.filter(F.col("step") >= taken[-1]["step"]).select("word", "n").collect()
    return [r["word"] for r in sorted(rows, key=lambda r: (-r["n"], r["word"]))]


def learnt_words(docs: DataFrame, vocabulary: str | None) -> Words:
    """The fixed list, then the words of the vocabulary file and of the corpus, each by its better rank."""
    lists = [corpus_words(docs), vocabulary_words(vocabulary) if vocabulary else []]
    ranks: dict[str, int] = {}
    for words in lists:
        for i, w in enumerate(words):
            ranks[w] = min(ranks.get(w, i), i)
    return Words([*WORDS, *sorted(ranks, key=lambda w: (ranks[w], w))])


def _spell(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, words: Words = FIXED) -> DataFrame:
    """``(doc_id, spans array<struct<kind,start,end>>)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for b in slices(batches, "text"):
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(t.decode("utf-8", "replace"), shared.value)]
                    for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])
    return arrow_map(docs_of(docs), run, "doc_id long, spans array<struct<kind:string,start:bigint,end:bigint>>")


def digest_columns(scanned: DataFrame) -> DataFrame:
    """Counts, base digest and spelled spans of the result of ``scan``."""
    def of(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def spelled(col):
        return F.concat_ws(",", F.transform(col, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                       x["end"].cast("string"))))
    base = F.filter("spans", lambda x: x["kind"] != "password")
    return scanned.select("doc_id", of("assign"), of("access"), of("hex"),
                          F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"),
                          spelled(F.col("spans")).alias("spans"), of("password"))
