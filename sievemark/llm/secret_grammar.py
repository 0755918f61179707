"""Secrets in texts: fixed patterns, and formats learned from them by grammar inference.

Base spans come from three fixed patterns. Their values are labelled credentials: for each kind, and for
ordinary long runs of characters, a prefix tree of a bounded sample is turned into a probabilistic automaton
by merging states whose symbol frequencies are statistically compatible. Every other run of credential
characters is a candidate, with a digit or without, and so is what a base span leaves of a run; it is a secret
if the best credential automaton makes it likelier, per character, than the automaton of ordinary runs by more
than a margin set on the samples, a margin of their own for runs without a digit. Learned spans are added, base
spans always stay.

Null and empty texts have no spans. Rows are independent of each other, so repeated rows give repeated
results; with no labelled credential at all only base spans are returned.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.llm.common import append_columns
from sievemark.session import cut_lineage

# The base patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST = {"assign": 6, "access": 20, "hex": 24}

# A learned secret has at least so many credential characters in a row.
LEAST_RUN = 16
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % LEAST_RUN)
DIGIT = re.compile(r"[0-9]")
LEARNED = "format"
REST = "rest"  # what base spans leave of a run: scored, not learned from
SAMPLE = 400  # values per kind that an automaton is learned from
# Classes of characters by which values are grouped before automata are learned.
SHAPES = [re.compile(c) for c in ("[0-9]", "[a-f]", "[g-z]", "[A-Z]", "[+/=]", "[_.-]")]
LEAST_SHAPE = 20  # values of a shape that has an automaton of its own
EVEN = 0.15  # log-likelihoods per character that count as equal
SPAN = "struct<kind:string,start:int,end:int,value:string>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by start, then kind as listed; offsets in code points, end exclusive."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for run in RUN.finditer(text):
        # A long access key or hex number lies within a run of credential characters.
        at, value = run.start(), run[0]
        if len(value) >= LEAST["access"] and "AKIA" in value:
            found += [("access", at + m.start(), at + m.end(), m[0]) for m in ACCESS.finditer(value) if len(m[0]) >= LEAST["access"]]
        if len(value) >= LEAST["hex"]:
            found += [("hex", at + m.start(), at + m.end(), m[0]) for m in HEX.finditer(value) if len(m[0]) >= LEAST["hex"]]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: Iterable[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Runs of credential characters outside all base spans, those without a digit as words, and long enough
    rests of the runs that base spans touch."""
    taken = sorted((s, e) for _, s, e, _ in base)
    out = []
    for m in RUN.finditer(text):
        touching = [(s, e) for s, e in taken if s < m.end() and m.start() < e]
        if not touching:
            out.append((LEARNED if DIGIT.search(m[0]) else "word", m.start(), m.end(), m[0]))
            continue
        at = m.start()
        for start, end in [*touching, (m.end(), m.end())]:
            if start - at >= LEAST_RUN:
                out.append((REST, at, start, text[at:start]))
            at = max(at, end)
    return out


class FormatAutomaton:
    """Probabilistic automaton learned by merging compatible states of a prefix tree."""

    FLOOR = math.log(1e-5)

    def __init__(self, strings: Iterable[str], alpha: float = 0.05):
        strings = list(strings)
        self.next: list[dict[str, int]] = [{}]
        self.hits: list[dict[str, int]] = [{}]
        self.ends: list[int] = [0]
        for s in strings:
            node = 0
            for c in s:
                to = self.next[node].get(c)
                if to is None:
                    to = self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.hits.append({})
                    self.ends.append(0)
                self.hits[node][c] = self.hits[node].get(c, 0) + 1
                node = to
            self.ends[node] += 1
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        total = [sum(h.values()) + e for h, e in zip(self.hits, self.ends)]
        # A state that few values reach is drawn to the frequencies of all of them.
        seen = Counter(c for s in strings for c in s)
        every = max(sum(seen.values()), 1)
        share = {c: n / every for c, n in seen.items()}
        self.log_hit = [{c: math.log((n + share[c]) / (t + 1)) for c, n in h.items()} for h, t in zip(self.hits, total)]
        self.log_rare = [math.log(1 / (t + 1)) for t in total]
        self.log_any = {c: math.log(p) for c, p in share.items()}
        self.log_end = [math.log((e + len(strings) / (every + len(strings) + 1)) / (t + 1)) if e or strings else self.FLOOR for e, t in zip(self.ends, total)]
        self._leave_tree()

    def _leave_tree(self) -> None:
        """Keeps the states that scoring can reach; the rest of the prefix tree would go to every task."""
        place, todo = {0: 0}, [0]
        for node in todo:
            for to in self.next[node].values():
                if to not in place:
                    place[to] = len(todo)
                    todo.append(to)
        self.next = [{c: place[to] for c, to in self.next[node].items()} for node in todo]
        self.log_hit, self.log_rare, self.log_end = ([v[node] for node in todo] for v in (self.log_hit, self.log_rare, self.log_end))
        del self.hits, self.ends

    def _total(self, node: int) -> int:
        return sum(self.hits[node].values()) + self.ends[node]

    def _alike(self, a: int, b: int) -> bool:
        """Hoeffding test on the end and on every symbol, for both states and all that follow."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            na, nb = self._total(a), self._total(b)
            if not na or not nb:
                continue
            most = self._bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if abs(self.ends[a] / na - self.ends[b] / nb) > most:
                return False
            for c in self.hits[a].keys() | self.hits[b].keys():
                if abs(self.hits[a].get(c, 0) / na - self.hits[b].get(c, 0) / nb) > most:
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.ends[a] += self.ends[b]
            for c, n in self.hits[b].items():
                self.hits[a][c] = self.hits[a].get(c, 0) + n
                if c in self.next[a]:
                    todo.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge_states(self) -> None:
        kept, edge = [0], deque((0, c) for c in sorted(self.next[0]))
        while edge:
            parent, c = edge.popleft()
            state = self.next[parent][c]
            if state in kept:
                continue
            for red in kept:
                if self._alike(red, state):
                    self.next[parent][c] = red
                    self._fold(red, state)
                    edge.extend((red, s) for s in sorted(self.next[red]) if self.next[red][s] not in kept)
                    break
            else:
                kept.append(state)
                edge.extend((state, s) for s in sorted(self.next[state]))
        self.states = len(kept)

    def score(self, s: str) -> float:
        """Log-likelihood per character, the end included; a symbol that was never seen costs a fixed amount,
        one that is new to a state is read from the start state."""
        node, total = 0, 0.0
        for c in s:
            p = self.log_hit[node].get(c)
            if p is None:
                total += max(self.log_rare[node] + self.log_any.get(c, self.FLOOR), self.FLOOR)
                node = self.next[0].get(c, node)
            else:
                total += p
                node = self.next[node][c]
        return (total + self.log_end[node]) / (len(s) + 1)


def shape(s: str) -> tuple[bool, ...]:
    """Which classes of characters a value has; values of one random format mostly share it."""
    return tuple(bool(p.search(s)) for p in SHAPES)


def _by_shape(values: Iterable[str]) -> dict[tuple[bool, ...], list[str]]:
    out: dict[tuple[bool, ...], list[str]] = {}
    for v in values:
        out.setdefault(shape(v), []).append(v)
    return out


def _automata(values: list[str]) -> list[FormatAutomaton]:
    """One automaton of all values and one of each frequent shape, which the first would blur."""
    groups = [v for v in _by_shape(values).values() if len(v) >= LEAST_SHAPE]
    return [FormatAutomaton(v) for v in ([values] if values else []) + (groups if len(groups) > 1 or groups and len(groups[0]) < len(values) else [])]


def _best(automata: Iterable[FormatAutomaton], s: str) -> float:
    return max((a.score(s) for a in automata), default=-math.inf)


class FormatModel:
    """The automata of all kinds of credentials and of ordinary runs, and the margin between them.

    Words are known to be ordinary. Other runs are a mixture: those of a labelled shape that labelled formats
    explain as well as a labelled value, and about as well as their own neighbours do, are likely credentials:
    they do not count as ordinary, and the automaton of their shape learns from them, too. The margin comes from labelled values and words only.

    A run without a digit is judged against words from which likely credentials are taken out in the same way. It
    has to exceed the margins of all other words, each read by automata that the word is not part of.
    """

    def __init__(self, labelled: dict[str, list[str]], ordinary: dict[str, list[str]]):
        self.kinds = {k: FormatAutomaton(v) for k, v in labelled.items() if v}
        values = list(dict.fromkeys(v for vs in labelled.values() for v in vs))
        self.formats = [*self.kinds.values(), *[FormatAutomaton(v) for v in _by_shape(values).values() if len(v) >= LEAST_SHAPE]]
        words = ordinary.get("word", [])
        known = _automata(words)
        others = [s for k, vs in ordinary.items() if k != "word" for s in self._unlike(values, vs, known)]
        self.ordinary = [*known, *_automata(others)] or [FormatAutomaton(["a"])]
        # Labelled values that could be candidates set the margin, all of them where there are none.
        good = sorted(self.margin(v) for v in [v for v in values if RUN.fullmatch(v) and DIGIT.search(v)] or values)
        bad = sorted(self.margin(v) for v in words)
        low = good[len(good) // 50] if good else 0.0
        high = bad[-1 - len(bad) // 200] if bad else 0.0
        self.threshold = max((low + high) / 2, high, min(max(low, 0.0), 0.25))
        formats = list(self.formats)
        plain = self._unlike(values, words, [])
        self.word_formats, self.formats = self.formats, formats
        rest = _automata(others)
        self.plain = [*_automata(plain), *rest] or [FormatAutomaton(["a"])]
        unseen = [[*_automata(plain[1 - i :: 2]), *rest] for i in (0, 1)]
        held_out = [_best(self.word_formats, s) - _best(unseen[i], s) for i in (0, 1) if unseen[i] for s in plain[i::2]]
        self.word_threshold = max([self.threshold, *held_out])

    def _unlike(self, values: list[str], runs: list[str], known: list[FormatAutomaton]) -> list[str]:
        """The runs without likely credentials."""
        halves = [_automata(values[i::2]) for i in (0, 1)]
        held_out = sorted(_best(halves[1 - i], v) for i in (0, 1) for v in values[i::2])
        least = held_out[len(held_out) // 50] - EVEN if held_out else math.inf
        shapes, out = _by_shape(values), []
        for form, group in _by_shape(runs).items():
            score = {s: _best(self.formats, s) for s in group} if form in shapes else {}
            rest, gained = group, []
            while rest and score:
                # Each half is judged by what the other half makes ordinary, and by all likely credentials so far.
                other = [[*known, FormatAutomaton(rest[1 - i :: 2])] for i in (0, 1)]
                kept = [s for j, s in enumerate(rest) if score[s] < least or score[s] < _best(other[j % 2], s) - EVEN]
                if len(kept) == len(rest):
                    break
                gained += sorted(set(rest).difference(kept))
                rest, grown = kept, FormatAutomaton(shapes[form] + gained)
                score = {s: max(score[s], grown.score(s)) for s in rest}
            if gained:
                self.formats.append(grown)
            out += rest
        return out

    def margin(self, s: str) -> float:
        return _best(self.formats, s) - _best(self.ordinary, s)

    def secret(self, s: str) -> bool:
        if not self.kinds:
            return False
        if DIGIT.search(s):
            return self.margin(s) > self.threshold
        return _best(self.word_formats, s) - _best(self.plain, s) > self.word_threshold

    def spans(self, found: Iterable[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
        """The base spans, and all candidates that are secrets."""
        return [s if s[0] in KINDS else (LEARNED, *s[1:]) for s in found if s[0] in KINDS or self.secret(s[3])]


def _found(text: str | None) -> list[tuple[str, int, int, str]]:
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + candidates(text, base), key=lambda s: (s[1], (*KINDS, LEARNED, "word", REST).index(s[0])))


def find_runs(df: DataFrame, text: str = "text", runs: str = "runs", drop: bool = False) -> DataFrame:
    """The rows with all base spans and candidates of their whole texts; with ``drop`` without the texts."""
    return append_columns(df, [text], f"`{runs}` array<{SPAN}>", lambda: lambda texts: [[_found(t) for t in texts]], drop)


def fit_formats(found: DataFrame, runs: str = "runs", sample: int = SAMPLE) -> FormatModel:
    """Learns the automata from distinct values of each kind, at most ``sample``, chosen by hash."""
    # Runs without a digit are ordinary; the others are not labelled, the model takes likely credentials out.
    ordinary = ("word", LEARNED)
    each = found.select(F.explode(runs).alias("r")).select("r.kind", "r.value").filter(F.col("kind").isin(*KINDS, *ordinary))
    # Stored, so that all rows are read and their values made distinct once, not for every kind.
    each = each.distinct().persist(StorageLevel.DISK_ONLY)

    def values(kind: str) -> list[str]:
        mine = each.filter(F.col("kind") == kind).select("value")
        return [r[0] for r in mine.orderBy(F.xxhash64("value"), "value").limit(sample).collect()]

    try:
        labelled, plain = {k: values(k) for k in KINDS}, {k: values(k) for k in ordinary}
    finally:
        each.unpersist()
    return FormatModel(labelled, plain)


def score_runs(found: DataFrame, model: FormatModel, runs: str = "runs", secrets: str = "secrets", drop: bool = False) -> DataFrame:
    """Keeps base spans and those candidates, words and rests too, that look like a learned format; with ``drop``
    without all others."""
    return append_columns(found, [runs], f"`{secrets}` array<{SPAN}>", lambda: lambda rows: [[model.spans(_tuples(r)) for r in rows]], drop)


def _tuples(spans: list[dict] | None) -> list[tuple]:
    return [(s["kind"], s["start"], s["end"], s["value"]) for s in spans or ()]


def secret_digests(df: DataFrame, text: str = "text") -> DataFrame:
    """Per row: counts of base spans, their digest, and all spans as text. Texts are read once."""
    narrow = cut_lineage(find_runs(df, text, drop=True))
    scored = score_runs(narrow, fit_formats(narrow), drop=True)

    def named(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def those(*kinds: str) -> Column:
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    # Spark works these out: a second Python function would be a second worker for every task.
    added = {f"n_{k}": F.size(those(k)).cast("bigint") for k in KINDS}
    added |= {"base_sha256": F.sha2(named(those(*KINDS)), 256), "spans": named(F.col("secrets"))}
    kept = [F.col(f"`{c}`") for c in scored.columns if c.lower() not in (*added, "secrets")]
    return scored.select(*kept, *[c.alias(n) for n, c in added.items()])


def redact(df: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows with every secret of their texts replaced by ``mark``; of overlapping spans the union goes."""
    model = fit_formats(find_runs(df.select(text), text, drop=True))

    def clean(t: str | None) -> str | None:
        if not t:
            return t
        spans = model.spans(_found(t))
        out, at = [], 0
        for _, start, end, _ in spans:
            if start >= at:
                out += [t[at:start], mark]
            at = max(at, end)
        return "".join([*out, t[at:]]) if spans else t

    return append_columns(df, [text], f"`{text}` string", lambda: lambda texts: [[clean(t) for t in texts]]).select(*df.columns)
