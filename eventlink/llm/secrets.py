"""Secrets in texts, found by one automaton for all rules.

Each rule is a regular expression over bytes.  The expressions are compiled together: subset construction
gives one deterministic automaton, minimisation shrinks it, byte classes narrow its table.  A text is read
once, byte by byte; the bytes of many text segments are fed side by side, so that a step is one look-up in
the transition array for thousands of segments.  Where a rule's match ends, the automaton of the reversed
rule walks back to its start.
"""

from __future__ import annotations

import functools
import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlink.llm.common import fresh, map_texts, raw


@dataclass(frozen=True)
class Rule:
    """``least``: characters that a match needs; with ``value_only`` those of its value, not of the keyword."""

    kind: str
    pattern: str
    least: int = 0
    value_only: bool = False


# The three base rules, in their order.
VALUE = "A-Za-z0-9+/_.=-"
BASE_RULES = [
    Rule(
        "assign",
        rf"(?i:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[{VALUE}]+)",
        12,
        value_only=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
]
MORE_RULES = [
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 24),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_.-]+", 30),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
]
RULES = [*BASE_RULES, *MORE_RULES]
SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)
#: Segments are cut, at bytes that end every match, about so many bytes apart.
STRIDE = 256


# --- compilation -----------------------------------------------------------------------------------------


class _Nfa:
    """States with byte moves and empty moves; an expression becomes a fragment (first, last)."""

    def __init__(self):
        self.moves: list[list[tuple[np.ndarray, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def _bytes(self, op, arg, fold: bool) -> np.ndarray:
        hit = np.zeros(256, bool)
        if op is sre.LITERAL:
            hit[arg] = True
        elif op is sre.IN:
            for o, a in arg:
                if o is sre.RANGE:
                    hit[a[0] : a[1] + 1] = True
                elif o is sre.LITERAL:
                    hit[a] = True
                else:
                    raise ValueError(f"not supported in a class: {o}")
        else:
            raise ValueError(f"not supported: {op}")
        if fold:
            up, low = hit[65:91].copy(), hit[97:123].copy()
            hit[65:91] |= low
            hit[97:123] |= up
        return hit

    def add(self, tree, back: bool, fold: bool = False) -> tuple[int, int]:
        first = last = self.state()
        for op, arg in reversed(list(tree)) if back else tree:
            if op is sre.SUBPATTERN:
                _, plus, _, inner = arg
                a, b = self.add(inner, back, fold or bool(plus & sre.SRE_FLAG_IGNORECASE))
            elif op is sre.BRANCH:
                a, b = self.state(), self.state()
                for inner in arg[1]:
                    x, y = self.add(inner, back, fold)
                    self.empty[a].append(x)
                    self.empty[y].append(b)
            elif op is sre.MAX_REPEAT:
                least, most, inner = arg
                a = b = self.state()
                for _ in range(least):
                    x, y = self.add(inner, back, fold)
                    self.empty[b].append(x)
                    b = y
                if most is sre.MAXREPEAT:
                    x, y = self.add(inner, back, fold)
                    self.empty[b].append(x)
                    self.empty[y].append(b)
                else:
                    end = self.state()
                    for _ in range(most - least):
                        x, y = self.add(inner, back, fold)
                        self.empty[b] += [x, end]
                        b = y
                    self.empty[b].append(end)
                    b = end
            else:
                a, b = self.state(), self.state()
                self.moves[a].append((self._bytes(op, arg, fold), b))
            self.empty[last].append(a)
            last = b
        return first, last

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``step[state * classes + kind[byte]]`` is the next state; ``accepts[state]`` has a bit for each rule."""

    step: np.ndarray
    kind: np.ndarray
    classes: int
    start: int
    accepts: np.ndarray
    dead: int  # a state without a way out, or -1


def compile_rules(patterns: list[str], anywhere: bool, back: bool = False) -> Automaton:
    """One minimal automaton.  ``anywhere``: a match may begin at any byte; ``back``: of the reversed patterns."""
    nfa, starts, finals = _Nfa(), [], {}
    for bit, p in enumerate(patterns):
        a, b = nfa.add(sre_parser.parse(p), back)
        starts.append(a)
        finals[b] = 1 << bit
    own = {id(hit): hit for moves in nfa.moves for hit, _ in moves}
    _, kind = np.unique(np.array([*own.values()]), axis=1, return_inverse=True)
    kind = kind.ravel().astype(np.uint8)
    sample = [int(np.flatnonzero(kind == c)[0]) for c in range(kind.max() + 1)]
    start = nfa.closure(starts)
    ids, todo, rows = {start: 0}, [start], []
    while todo:
        states, row = todo.pop(0), []
        for byte in sample:
            to = {t for s in states for hit, t in nfa.moves[s] if hit[byte]}
            to = nfa.closure(to | set(starts) if anywhere else to)
            if to not in ids:
                ids[to] = len(ids)
                todo.append(to)
            row.append(ids[to])
        rows.append(row)
    step = np.array(rows)
    accepts = np.array([sum({finals.get(s, 0) for s in states}) for states in ids])
    block = np.unique(accepts, return_inverse=True)[1].ravel()
    while True:  # states stay together while all their moves lead to the same blocks
        finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    _, rep = np.unique(block, return_index=True)
    order = np.argsort(accepts[rep], kind="stable")  # accepting states come last
    place = np.argsort(order)
    block, rep = place[block], rep[order]
    step = block[step[rep]]
    loops = (step == np.arange(len(step))[:, None]).all(axis=1) & (accepts[rep] == 0)
    return Automaton(
        step.astype(np.int32).ravel(),
        kind,
        step.shape[1],
        int(block[0]),
        accepts[rep].astype(np.int64),
        int(np.flatnonzero(loops)[0]) if loops.any() else -1,
    )


# --- scanning ----------------------------------------------------------------------------------------------


class Scanner:
    def __init__(self, rules: list[Rule]):
        self.rules = rules
        self.all = compile_rules([r.pattern for r in rules], anywhere=True)
        self.back = [compile_rules([r.pattern], anywhere=False, back=True) for r in rules]
        a = self.all
        by_class = a.step.reshape(-1, a.classes)
        self.resets = ((by_class == a.start).all(axis=0) & (a.accepts[a.start] == 0))[a.kind]

    def ends(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes at which some rule's match may end, and the rules as bits: one pass over all bytes."""
        a = self.all
        free = np.flatnonzero(self.resets[buf]) + 1
        free = free[np.unique(free // STRIDE, return_index=True)[1]]
        begin = np.union1d(offsets[:-1], free[free < len(buf)])
        begin = begin[begin < len(buf)]
        size = np.diff(np.append(begin, len(buf)))
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        # begin is split at every document's start, so no segment crosses one
        first_accept = int(np.searchsorted(a.accepts > 0, True))
        kinds = a.kind[buf]
        state = np.full(len(begin), a.start, np.int32)
        at, bits = [], []
        live = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
        for t, n in enumerate(live.tolist()):
            s = a.step[state[:n] * a.classes + kinds[begin[:n] + t]]
            state[:n] = s
            hit = np.flatnonzero(s >= first_accept)
            if len(hit):
                at.append(begin[hit] + t)
                bits.append(a.accepts[s[hit]])
        if not at:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at, bits = np.concatenate(at), np.concatenate(bits)
        order = np.argsort(at)
        return at[order], bits[order]

    def _starts(self, rule: int, text: bytes, end: int, least: int) -> int | None:
        """The leftmost start, not before ``least``, of a match of the rule that ends with byte ``end - 1``."""
        a, best = self.back[rule], None
        state, step, kind, n = a.start, a.step, a.kind, a.classes
        for i in range(end - 1, least - 1, -1):
            state = step[state * n + kind[text[i]]]
            if state == a.dead:
                break
            if a.accepts[state]:
                best = i
        return best

    def _fits(self, rule: Rule, match: bytes) -> bool:
        if not rule.value_only:
            return len(match) >= rule.least
        return self._value_size(match) >= rule.least

    def _value_size(self, match: bytes) -> int:
        """Length of the value: what follows keyword, quote, spaces, separator, spaces, quote."""
        i = 0
        while chr(match[i]) not in ":=":
            i += 1
        i += 1
        while i < len(match) and match[i] == 0x20:
            i += 1
        if i < len(match) and match[i] in b"\"'":
            i += 1
        return len(match) - i

    def spans(self, column: pa.Array) -> list[list[dict]]:
        """Spans of each text in code points, by start and then by the rules' order."""
        buf, offsets = raw(column)
        out: list[list[dict]] = [[] for _ in range(len(column))]
        at, bits = self.ends(buf, offsets)
        if not len(at):
            return out
        doc = np.searchsorted(offsets, at, side="right") - 1
        for d in np.unique(doc).tolist():
            lo, hi = np.searchsorted(doc, [d, d + 1])
            base, found = int(offsets[d]), []
            text = buf[base : offsets[d + 1]].tobytes()
            where, which = at[lo:hi] - base, bits[lo:hi]
            for r, rule in enumerate(self.rules):
                own = where[(which >> r) & 1 == 1]
                own = own[np.append(np.diff(own) > 1, True)] if len(own) else own  # a match goes on as far as it can
                free = 0
                for e in own.tolist():
                    start = self._starts(r, text, e + 1, free)
                    if start is not None:
                        free = e + 1
                        if self._fits(rule, text[start : e + 1]):
                            found.append((start, r, e + 1))
            if found:
                before = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
                chars = lambda i: int(before[i - 1]) if i else 0
                out[d] = [
                    {"kind": self.rules[r].kind, "start": chars(s), "end": chars(e)} for s, r, e in sorted(found)
                ]
        return out


@functools.lru_cache(maxsize=8)
def scanner_of(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(list(rules))


def scan_secrets(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, rules: list[Rule] = RULES, out: str = "spans"
) -> DataFrame:
    """The secrets of every text as ``out``: array of (kind, start, end), code points, end exclusive.

    Matches are leftmost and do not overlap within a kind; matches that are too short are left out after
    that.  Null and empty texts have no spans; repeated rows are scanned each; other columns are kept as
    they are (all, or those in ``keep``), and a column named like ``out`` is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]

    scanner = scanner_of(tuple(rules))  # compiled once, by the driver

    def make():
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return lambda part: [pa.array(scanner.spans(part), kind)]

    return map_texts(docs, text, keep, [T.StructField(out, T.ArrayType(SPAN))], make)


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", n_chars: str = "n_chars") -> DataFrame:
    """Every secret replaced by ``mark``; spans that touch or overlap become one mark.

    Rows and columns stay as they are but for the text and its length, where ``n_chars`` exists.
    """
    spans = fresh(docs, "_spans")
    found = scan_secrets(docs, text, out=spans)
    one = F.struct(F.col(f"{spans}.start")[0].alias("start"), F.col(f"{spans}.end")[0].alias("end"))
    joined = F.aggregate(
        F.slice(spans, 2, F.greatest(F.size(spans) - 1, F.lit(0))),
        F.array(one),
        lambda acc, s: F.when(
            s["start"] <= F.element_at(acc, -1)["end"],
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)["start"].alias("start"),
                        F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    at = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done"))
    whole = F.col(text)
    built = F.aggregate(
        joined,
        at,
        lambda acc, s: F.struct(
            s["end"].alias("at"),
            F.concat(
                acc["done"],
                whole.substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                F.lit(mark),
            ).alias("done"),
        ),
        lambda acc: F.concat(acc["done"], whole.substr((acc["at"] + 1).cast("int"), F.char_length(whole))),
    )
    new = fresh(docs, "_redacted")
    found = found.withColumn(new, F.when(F.size(spans) > 0, built).otherwise(whole))
    put = {text: F.col(new)}
    if n_chars in docs.columns:
        size = F.when(F.size(spans) > 0, F.char_length(new)).otherwise(F.col(n_chars))
        put[n_chars] = size.cast(docs.schema[n_chars].dataType)
    return found.select(*[put[c].alias(c) if c in put else F.col(c) for c in docs.columns])


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of every document; see ``op4_secret_scan``."""
    spans = scan_secrets(docs.select("doc_id", "text"), keep=["doc_id"])
    kinds = [r.kind for r in BASE_RULES]
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda a: F.array_join(F.transform(a, line), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return spans.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
