"""Secret scans: all rules as one minimal automaton, run over every byte once."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import cached_property, lru_cache
from re import _constants as K, _parser as regex_syntax

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlode.llm import arrays as A


@dataclass(frozen=True)
class Rule:
    """A match counts when ``group`` has at least ``least`` characters. ``any_case``: ASCII letters in either."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False


# The base rules, in the order in which spans with one start are listed.
BASE = (
    Rule("assign", "(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         2, 6, True),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    # The least length of 24 stands in the pattern: a match is a whole run, so one that is too short holds no
    # other, and the automaton reports long runs only.
    Rule("hex", "[0-9a-f]{24,}"),
)
#: Further kinds that the automaton finds in the same pass.
ADDED = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + ADDED


class _Nfa:
    """States with steps on sets of bytes and empty steps."""

    def __init__(self) -> None:
        self.steps: list[list[tuple[np.ndarray, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.empty.append([])
        return len(self.steps) - 1

    def add(self, parsed, at: int, any_case: bool) -> int:
        """Append what a parsed expression matches; returns the state reached."""
        for kind, value in parsed:
            if kind in (K.LITERAL, K.IN):
                bytes_ = np.zeros(256, bool)
                for k, v in ([(kind, value)] if kind is K.LITERAL else value):
                    if k is K.LITERAL:
                        bytes_[v] = True
                    elif k is K.RANGE:
                        bytes_[v[0]:v[1] + 1] = True
                    else:
                        raise ValueError(f"not in the rules' syntax: {k}")
                if any_case:
                    letters = bytes_[0x41:0x5B] | bytes_[0x61:0x7B]
                    bytes_[0x41:0x5B] = bytes_[0x61:0x7B] = letters
                to = self.state()
                self.steps[at].append((bytes_, to))
            elif kind is K.BRANCH:
                to = self.state()
                for one in value[1]:
                    self.empty[self.add(one, at, any_case)].append(to)
            elif kind is K.SUBPATTERN:
                to = self.add(value[3], at, any_case)
            elif kind is K.MAX_REPEAT:
                low, high, inner = value
                to = at
                for _ in range(low):
                    to = self.add(inner, to, any_case)
                if high is K.MAXREPEAT:
                    loop = self.state()
                    self.empty[to].append(loop)
                    self.empty[self.add(inner, loop, any_case)].append(loop)
                    to = loop
                else:
                    end = self.state()
                    for _ in range(high - low):
                        self.empty[to].append(end)
                        to = self.add(inner, to, any_case)
                    self.empty[to].append(end)
                    to = end
            else:
                raise ValueError(f"not in the rules' syntax: {kind}")
            at = to
        return at

    def reach(self, states) -> int:
        """The states as bits, with all that empty steps lead to."""
        seen, todo = 0, list(states)
        while todo:
            s = todo.pop()
            if not seen >> s & 1:
                seen |= 1 << s
                todo += self.empty[s]
        return seen

    def reverse(self, start: int, end: int) -> tuple[_Nfa, int, int]:
        out = _Nfa()
        for _ in self.steps:
            out.state()
        for s, steps in enumerate(self.steps):
            for bytes_, to in steps:
                out.steps[to].append((bytes_, s))
            for to in self.empty[s]:
                out.empty[to].append(s)
        return out, end, start


@dataclass
class Automaton:
    """``following[state * 256 + byte]`` is the next state times 256. States from ``limit`` on accept the rules in
    ``accepts``; state 0 is where it starts, and ``dead`` the state that nothing leaves."""

    following: np.ndarray
    limit: int
    accepts: list[tuple[int, ...]]
    dead: int

    @cached_property
    def table(self) -> list[int]:
        return self.following.tolist()


def _automaton(nfa: _Nfa, starts: list[int], ends: list[int], search: bool) -> Automaton:
    """Subset construction, then minimisation. With ``search`` a match may begin at any byte."""
    masks = {m.tobytes() for steps in nfa.steps for m, _ in steps}
    of_byte = np.array([np.frombuffer(m, bool) for m in sorted(masks)]).T
    kinds, klass = np.unique(of_byte, axis=0, return_inverse=True)
    first = [int(np.flatnonzero(klass == c)[0]) for c in range(len(kinds))]
    move = [[nfa.reach(to for m, to in steps if m[b]) for b in first] if steps else [] for steps in nfa.steps]
    begin = nfa.reach(starts)
    again = begin if search else 0
    number, order, rows = {begin: 0}, [begin], []
    for now in order:
        row = []
        steps = [moves for i, moves in enumerate(move) if now >> i & 1 and moves]
        for c in range(len(first)):
            to = again
            for m in steps:
                to |= m[c]
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        rows.append(row)
    step = np.array(rows)
    salt = A.mix(np.arange(1, len(first) + 2, dtype=np.uint64))
    accept = np.array([sum(1 << r for r, e in enumerate(ends) if s >> e & 1) for s in order])
    part = np.unique(accept, return_inverse=True)[1]
    while True:
        # States stay together while they and all their successors lie in the same parts.
        name = A.mix(part.astype(np.uint64) + np.uint64(1))
        finer = np.unique(name * salt[0] + (name[step] * salt[1:]).sum(axis=1, dtype=np.uint64), return_inverse=True)[1]
        if finer.max() == part.max():
            break
        part = finer
    one = np.unique(part, return_index=True)[1]
    # The start first, accepting states last.
    rank = np.argsort([(-1 if p == part[0] and not accept[0] else int(accept[one[p]] > 0)) for p in range(len(one))],
                      kind="stable")
    place = np.empty(len(one), int)
    place[rank] = np.arange(len(one))
    merged = place[part[step[one[rank]]]][:, klass]
    accepts = [tuple(r for r in range(len(ends)) if int(accept[one[p]]) >> r & 1) for p in rank]
    limit = 256 * next((i for i, a in enumerate(accepts) if a), len(accepts))
    dead = next((256 * i for i in range(len(one)) if not accepts[i] and (merged[i] == i).all()), -1)
    return Automaton(256 * merged.ravel().astype(np.int32), limit, accepts, dead)


@lru_cache(maxsize=8)
def compile_rules(rules: tuple[Rule, ...] = RULES):
    """One searching automaton for all rules, and per rule one backwards, to the start of a match, and one
    forwards, to its end."""
    joint, starts, ends, backward, forward = _Nfa(), [], [], [], []
    for rule in rules:
        parsed = regex_syntax.parse(rule.pattern)
        start = joint.state()
        starts.append(start)
        ends.append(joint.add(parsed, start, rule.any_case))
        alone = _Nfa()
        first = alone.state()
        last = alone.add(parsed, first, rule.any_case)
        forward.append(_automaton(alone, [first], [last], False))
        back, a, b = alone.reverse(first, last)
        backward.append(_automaton(back, [a], [b], False))
    checks = [re.compile(r.pattern.encode(), re.IGNORECASE if r.any_case else 0) for r in rules]
    return _automaton(joint, starts, ends, True), backward, forward, checks


def _run(automaton: Automaton, steps, at: int, move: int) -> int:
    """The last position at which the automaton accepts, or -1."""
    state, found, table, limit, dead = 0, -1, automaton.table, automaton.limit, automaton.dead
    for byte in steps:
        state = table[state + byte]
        at += move
        if state >= limit:
            found = at
        elif state == dead:
            break
    return found


def scan_bytes(data: bytes, rules: tuple[Rule, ...] = RULES, compiled=None) -> list[tuple[int, int, int]]:
    """Leftmost matches that do not overlap, per rule: (start, rule, end) in bytes, sorted.

    The searching automaton reads each byte once and says where a match of which rule has come to be complete; from
    there the rule's own automata find where the longest such match starts and ends. A match too short is
    consumed all the same.
    """
    search, backward, forward, checks = compiled or compile_rules(rules)
    table, limit, accepts = search.table, search.limit, search.accepts
    resume, found, state = [0] * len(rules), [], 0
    view = memoryview(data)
    for i, byte in enumerate(data):
        state = table[state + byte]
        if state >= limit:
            for r in accepts[state >> 8]:
                if i >= resume[r]:
                    start = _run(backward[r], view[resume[r]:i + 1][::-1], i + 1, -1)
                    if start >= 0:
                        end = _run(forward[r], view[start:], start, 1)
                        resume[r] = end
                        rule = rules[r]
                        a, b = checks[r].fullmatch(data, start, end).span(rule.group)
                        if b - a >= rule.least:
                            found.append((start, r, end))
    return sorted(found)


def scan_documents(documents: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for each document.

    ``spans`` lists kind:start:end in code points by start, then kind, with the further kinds ``github`` and
    ``private_key`` after the base ones; ``base_sha256`` is the digest of the base spans alone. A null or empty
    text has none. Repeated rows give repeated results. Other columns are ignored; an empty table gives no rows.
    """
    compiled = documents.sparkSession.sparkContext.broadcast(compile_rules(RULES))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans = [], [], []
        for data in batch.column("text").cast(pa.binary()).to_pylist():
            found = scan_bytes(data, RULES, compiled.value) if data else []
            if found and not data.isascii():
                # Code points before each byte: those bytes that do not continue one.
                heads = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
                found = [(int(heads[a]), r, int(heads[b])) for a, r, b in found]
            text = [f"{RULES[r].kind}:{a}:{b}" for a, r, b in found]
            base = ",".join(t for t, (_, r, _) in zip(text, found) if r < len(BASE))
            counts.append([sum(r == k for _, r, _ in found) for k in range(len(BASE))])
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            spans.append(",".join(text))
        n = np.array(counts, np.int64)
        return A.batch_of(doc_id=batch.column("doc_id"), n_assign=n[:, 0], n_access=n[:, 1], n_hex=n[:, 2],
                          base_sha256=digests, spans=spans)

    return documents.select("doc_id", "text").mapInArrow(
        A.by_batch(work), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
