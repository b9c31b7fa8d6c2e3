"""Secret scans by a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived that every
match satisfies. Texts are indexed in blocks: for each trigram that a rule asks for, the
sorted places of the texts that have it. A rule's query is answered by intersecting and
uniting these postings, and only the texts that are left are searched by the expression
itself. A rule without mandatory trigrams is searched in every text. The index ignores
the case of ASCII letters.

A span is kind, start and end in code points, end exclusive. Matches are leftmost and do
not overlap within a kind; one that is too short is dropped after it was matched. A null
text counts as empty and has no span. Repeated rows give repeated results.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import Texts, pieces, texts_of

FLAGS = re.ASCII


class Rule(NamedTuple):
    kind: str
    pattern: str
    least: int = 1
    group: int = 0  # whose length counts
    anycase: bool = False


#: Fixed patterns and lengths of the base kinds, in the order of their kinds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
#: Public shapes of further tokens.
FURTHER = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{20,}"),
)
RULES = BASE + FURTHER

#: Strings and members that a derivation keeps apart before it settles for less.
MOST_STRINGS, MOST_MEMBERS, ENDS = 64, 8, 2

# A query is None (no demand), a trigram, or ("and" | "or", frozenset of queries).
Query = object


def both(*queries: Query) -> Query:
    parts: set = set()
    for q in queries:
        if isinstance(q, tuple) and q[0] == "and":
            parts |= q[1]
        elif q is not None:
            parts.add(q)
    return None if not parts else parts.pop() if len(parts) == 1 else ("and", frozenset(parts))


def either(*queries: Query) -> Query:
    if not queries or None in queries:
        return None
    parts: set = set()
    for q in queries:
        parts |= q[1] if isinstance(q, tuple) and q[0] == "or" else {q}
    return parts.pop() if len(parts) == 1 else ("or", frozenset(parts))


def spelled(strings: set[str]) -> Query:
    """The trigrams of one of the strings."""
    return either(*(both(*{s[i : i + 3] for i in range(len(s) - 2)}) for s in strings))


class Known(NamedTuple):
    """What is known of the matches of a part: all of them (or None), how they begin and
    end, and the trigrams that they have."""

    exact: frozenset[str] | None
    begin: frozenset[str]
    end: frozenset[str]
    query: Query

    def settled(self) -> Known:
        """Without the exact strings."""
        if self.exact is None:
            return self
        return Known(
            None, frozenset(s[:ENDS] for s in self.exact), frozenset(s[-ENDS:] for s in self.exact),
            both(self.query, spelled(set(self.exact))),
        )


NOTHING = frozenset({""})
EMPTY, ANYTHING = Known(NOTHING, NOTHING, NOTHING, None), Known(None, NOTHING, NOTHING, None)


def after(a: Known, b: Known) -> Known:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST_STRINGS:
        return Known(frozenset(x + y for x in a.exact for y in b.exact), NOTHING, NOTHING, both(a.query, b.query))
    begin = frozenset(x + y for x in a.exact for y in (b.exact or b.begin)) if a.exact is not None else a.begin
    end = frozenset(x + y for x in (a.exact or a.end) for y in b.exact) if b.exact is not None else b.end
    seam = spelled({x + y for x in (a.exact or a.end) for y in (b.exact or b.begin)})
    a, b = a.settled(), b.settled()
    bounded = lambda strings, cut: frozenset(map(cut, strings)) if len(strings) <= MOST_STRINGS else NOTHING
    return Known(
        None, bounded(begin, lambda s: s[:ENDS]), bounded(end, lambda s: s[-ENDS:] if s else s), both(a.query, b.query, seam)
    )


def one_of(parts: list[Known]) -> Known:
    if all(p.exact is not None for p in parts) and sum(len(p.exact) for p in parts) <= MOST_STRINGS:
        return Known(frozenset().union(*(p.exact for p in parts)), NOTHING, NOTHING, either(*(p.query for p in parts)))
    parts = [p.settled() for p in parts]
    return Known(
        None, frozenset().union(*(p.begin for p in parts)), frozenset().union(*(p.end for p in parts)),
        either(*(p.query for p in parts)),
    )


def members(items: list) -> frozenset[str] | None:
    """The folded characters of a set, if they are few."""
    found: set[str] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            found.add(chr(value).lower())
        elif kind is sre.RANGE and value[1] - value[0] < 64:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(found) if len(found) <= MOST_MEMBERS and all(c.isascii() for c in found) else None


def known_of(parsed) -> Known:
    out = EMPTY
    for kind, value in parsed:
        if kind is sre.LITERAL:
            char = chr(value).lower()
            part = Known(frozenset({char}), NOTHING, NOTHING, None) if char.isascii() else ANYTHING
        elif kind is sre.IN:
            found = members(value)
            part = Known(found, NOTHING, NOTHING, None) if found else ANYTHING
        elif kind is sre.BRANCH:
            part = one_of([known_of(x) for x in value[1]])
        elif kind is sre.SUBPATTERN:
            part = known_of(value[3])
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, inner = value
            inner = known_of(inner)
            if most == 1:
                part = one_of([EMPTY, inner]) if least == 0 else inner
            elif least == 0:
                part = ANYTHING
            else:
                part = inner
                for _ in range(min(least, 3) - 1):
                    part = after(part, inner)
                if most > min(least, 3):
                    part = part.settled()
        elif kind is sre.AT:
            part = EMPTY
        else:
            part = ANYTHING
        out = after(out, part)
    return out


def query_of(rule: Rule) -> Query:
    """The trigrams, in lower case, that a text must have for the rule to match."""
    return known_of(parser.parse(rule.pattern, FLAGS)).settled().query


def trigrams_in(query: Query) -> set[str]:
    if isinstance(query, tuple):
        return set().union(*map(trigrams_in, query[1]))
    return set() if query is None else {query}


FOLD = np.arange(256, dtype=np.int64)
FOLD[ord("A") : ord("Z") + 1] += 32


class Index(NamedTuple):
    """Of the texts of a block: for each trigram the sorted places of those that have it."""

    size: int
    postings: dict[str, np.ndarray]

    def answer(self, query: Query) -> np.ndarray:
        if query is None:
            return np.arange(self.size)
        if isinstance(query, str):
            return self.postings.get(query, np.zeros(0, np.int64))
        parts = sorted((self.answer(q) for q in query[1]), key=len)
        if query[0] == "or":
            return np.unique(np.concatenate(parts))
        found = parts[0]
        for part in parts[1:]:
            found = np.intersect1d(found, part, assume_unique=True)
        return found


def indexed(texts: Texts, trigrams: list[str], wanted: np.ndarray) -> Index:
    """``trigrams`` in order; ``wanted``: whether a trigram's code is one of them."""
    data, offsets = texts
    size = len(offsets) - 1
    if len(data) < 3 or not trigrams:
        return Index(size, {})
    low = FOLD[data]
    codes = low[:-2] << 16 | low[1:-1] << 8 | low[2:]
    at = np.flatnonzero(wanted[codes])
    text = np.searchsorted(offsets, at, "right") - 1
    inside = at + 3 <= offsets[text + 1]
    codes, text = codes[at[inside]], text[inside]
    pairs = np.unique(codes * size + text)
    codes, text = pairs // size, pairs % size
    known = np.array([int.from_bytes(t.encode()) for t in trigrams])
    cuts = np.searchsorted(codes, known), np.searchsorted(codes, known, "right")
    return Index(size, {t: text[a:b] for t, a, b in zip(trigrams, *cuts, strict=True) if b > a})


class Scanner:
    """Expressions, queries and trigrams of the rules."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = [(r, re.compile(r.pattern, FLAGS | (re.IGNORECASE if r.anycase else 0)), query_of(r)) for r in rules]
        self.trigrams = sorted(set().union(*(trigrams_in(q) for _, _, q in self.rules)))
        self.wanted = np.zeros(1 << 24, bool)
        self.wanted[[int.from_bytes(t.encode()) for t in self.trigrams]] = True

    def index(self, texts: Texts) -> Index:
        return indexed(texts, self.trigrams, self.wanted)

    def spans(self, batch: pa.RecordBatch) -> list[list[tuple[int, int, int]]]:
        """(start, rule, end) of the matches in each text, in order."""
        index, column = self.index(texts_of(batch["text"])), batch["text"]
        plain: dict[int, str] = {}
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(batch.num_rows)]
        for number, (rule, pattern, query) in enumerate(self.rules):
            for i in index.answer(query).tolist():
                text = plain.get(i)
                if text is None:
                    text = plain[i] = column[i].as_py() or ""
                out[i] += [
                    (m.start(), number, m.end()) for m in pattern.finditer(text)
                    if m.end(rule.group) - m.start(rule.group) >= rule.least
                ]
        return [sorted(found) for found in out]



def found(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``docs``: doc_id and spans, an array of (kind, start, end)."""

    def run(batches):
        scanner = Scanner(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for piece in pieces(batch):
                rows = [
                    [{"kind": rules[rule].kind, "start": start, "end": end} for start, rule, end in spans]
                    for spans in scanner.spans(piece)
                ]
                yield pa.record_batch({"doc_id": piece["doc_id"], "spans": pa.array(rows, kind)})

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


#: Texts whose ids one row of a posting list may hold, about.
LISTED = 1 << 16


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES, listed: int = LISTED) -> DataFrame:
    """The index itself, to look at or keep: trigram, part and the ascending ids of the texts that
    have it, a repeated id once for each of its rows. Ids are dealt out to as many parts as keep
    a list, of whatever trigram, near ``listed`` ids. Rows without an id are not listed."""

    def run(batches):
        scanner = Scanner(rules)
        for batch in batches:
            for piece in pieces(batch):
                ids = piece["doc_id"]
                lists = scanner.index(texts_of(piece["text"])).postings
                yield pa.record_batch({
                    "trigram": pa.array(list(lists), pa.string()),
                    "doc_ids": pa.array([ids.take(pa.array(p)).to_pylist() for p in lists.values()], pa.list_(pa.int64())),
                })

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    parts = max(1, -(-slim.count() // listed))
    each = slim.mapInArrow(run, "trigram string, doc_ids array<long>").select("trigram", F.explode("doc_ids").alias("doc_id"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int")
    return each.groupBy("trigram", part.alias("part")).agg(F.sort_array(F.collect_list("doc_id")).alias("doc_ids"))


def digests(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: how many spans of each base kind, the sha256 of these, and all spans."""
    kinds = [rule.kind for rule in BASE]
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    of_kind = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in kinds]
    return found(docs, rules).select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
