"""Byte-level BPE as a lazily determinised finite-state transducer, and incremental decoding.

A token sequence is the encoding of its bytes exactly if every token encodes to itself and every two
neighbours encode to themselves together. That makes encoding a walk over a finite automaton whose states
are (last token, place in the trie of tokens): from a place that ends a token one may go back to the root
if the token may follow the last one. ``BpeTransducer`` determinises this automaton while it reads: a state
is the set of live hypotheses, each with the tokens on which the others disagree, and a step emits the
tokens on which all agree. No hypothesis can fall behind by more than the longest token, which bounds the
lookahead. States and steps are built when first met, up to a bound; beyond it hypotheses are followed without
being stored. The results for chunks of text between blanks, which repeat a lot, are forgotten when too many.

Null texts count as empty, an empty text has no ids. Rows are independent: repeated rows give repeated
results. Added columns replace input columns of the same name, all others are kept.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import chain

from pyspark.sql import DataFrame

from sievemark.llm.common import append_columns, module_cache, without_collection

# The characters with the Unicode property White_Space.
WHITE_SPACE = "\t\n\v\f\r \x85\xa0                　"
ROOT = 0
MAX_STATES = 150_000
MAX_CHUNKS = 300_000
DECODE_PIECE = 4096
LONG_CHUNK = 64  # characters; longer chunks are not remembered


class BpeTransducer:
    """Encoder for one rank file and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_states: int = MAX_STATES, max_chunks: int = MAX_CHUNKS):
        import regex

        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.max_states, self.max_chunks = max_states, max_chunks
        self._build_trie()
        self._joins: dict[int, bool] = {}
        self._split_of: dict[int, tuple[int, int] | None] = {}
        self._state_ids: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._steps: dict[int, tuple[tuple[int, ...], int]] = {}
        self._start = self._state((None, (((), ROOT),)))
        self._young: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}
        # Under such a pattern a run of letters, with a blank before it or not, is one match.
        self._letters_are_one = r" ?\p{L}+" in pattern and not re.search(r"\(\?!|\(\?<", pattern.replace(r"\s+(?!\S)", ""))
        space = re.escape(WHITE_SPACE)
        self._odd_space = re.compile(f" [{space}]|[{space}] |^[{space}]|[{space}]$").search
        self._units = re.compile(f" ?[^{space}]+|[{space}]+(?![^{space}])|[{space}]+").findall

    def _build_trie(self) -> None:
        step: dict[int, int] = {}
        token_at: dict[int, int] = {}
        inner: set[int] = set()
        nodes = 1
        for token, rank in self.ranks.items():
            node = ROOT
            for b in token:
                inner.add(node)
                key = node << 8 | b
                if key not in step:
                    step[key] = nodes
                    nodes += 1
                node = step[key]
            token_at[node] = rank
        self._trie, self._token_at, self._inner = step, token_at, inner

    def merge(self, piece: bytes, below: int = 1 << 60) -> list[int]:
        """Ids by merging the pair of lowest rank (under ``below``) again and again: what the transducer must give."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        known = self._split_of.get(token, 0)
        if known == 0:
            data, known = self.bytes_of[token], None
            if len(data) > 1:
                a, b = self.merge(data, below=token)
                known = (a, b)
            self._split_of[token] = known
        return known

    def _may_follow(self, last: int | None, token: int) -> bool:
        """Whether both tokens stay as they are when their bytes are merged together.

        Undoes the merges at the border from the latest to the earliest; the pair breaks if at any of these
        moments the two parts that meet at the border could merge before the next one to be undone.
        """
        if last is None:
            return True
        key = last << 20 | token
        known = self._joins.get(key)
        if known is None:
            if len(self._joins) > 4 * self.max_states:
                self._joins.clear()
            known = self._joins[key] = self._border_holds(last, token)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        limit = 1 << 60
        while True:
            if self.ranks.get(self.bytes_of[left] + self.bytes_of[right], 1 << 60) < limit:
                return False
            undo_left = self._halves(left) if left > right else None
            if undo_left is None and (halves := self._halves(right)) is not None and (left <= right or self._halves(left) is None):
                limit, right = right + 1, halves[0]
                continue
            undo_left = undo_left or self._halves(left)
            if undo_left is None:
                return True
            limit, left = left, undo_left[1]

    def _state(self, state: tuple) -> int:
        found = self._state_ids.get(state)
        if found is None:
            found = self._state_ids[state] = len(self._states)
            self._states.append(state)
        return found

    def _new_step(self, sid: int, b: int) -> tuple[tuple[int, ...], int]:
        """Hypotheses stay in the order of their starts; exactly one ends a token here and comes last."""
        last, live = self._states[sid]
        trie, tokens = self._trie, self._token_at
        out, ended, empty = [], None, False
        for pending, node in live:
            node = trie.get(node << 8 | b)
            if node is None:
                continue
            if node in self._inner:
                out.append((pending, node))
                empty = empty or not pending
            if ended is None and node in tokens:
                token = tokens[node]
                if self._may_follow(pending[-1] if pending else last, token):
                    ended = (*pending, token)
        out.append((ended, ROOT))
        agreed = 0
        if not empty:
            first = out[0][0]
            while agreed < len(first) and all([len(p) > agreed and p[agreed] == first[agreed] for p, _ in out]):
                agreed += 1
        emitted = ended[:agreed]
        if agreed:
            last = emitted[-1]
            out = [(p[agreed:], n) for p, n in out]
            empty = any([not p for p, _ in out])
        state = (last if empty else None, tuple(out))
        step = self._steps[sid << 8 | b] = (emitted, self._state(state))
        return step

    def _walk(self, sid: int, rest: bytes) -> tuple[int, ...]:
        """Tokens from a state to the end of the bytes, following its hypotheses without storing what they become."""
        last, live = self._states[sid]
        trie, tokens, inner, final = self._trie, self._token_at, self._inner, len(rest) - 1
        for i, b in enumerate(rest):
            out, ended = [], None
            for pending, node in live:
                node = trie.get(node << 8 | b)
                if node is None:
                    continue
                if ended is None and node in tokens:
                    token = tokens[node]
                    if self._may_follow(pending[-1] if pending else last, token):
                        ended = (*pending, token)
                        if i == final:
                            return ended
                if node in inner:
                    out.append((pending, node))
            out.append((ended, ROOT))
            live = out
        raise ValueError("no hypothesis ends here")

    def transduce(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one match of the pattern.

        States are stored while there is room. The last byte, whose step many words do not share, and all bytes
        after an unknown step when the room is used up are followed without being stored.
        """
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        sid, steps, out, final = self._start, self._steps, [], len(piece) - 1
        for i, b in enumerate(piece):
            step = steps.get(sid << 8 | b)
            if step is None:
                if i == final or len(self._states) >= self.max_states:
                    return (*out, *self._walk(sid, piece[i:]))
                step = self._new_step(sid, b)
            emitted, sid = step
            if emitted:
                out += emitted
        for pending, node in self._states[sid][1]:
            if node == ROOT:
                out += pending
                break
        return tuple(out)

    def pieces(self, chunk: str) -> list[str]:
        """Matches of the pattern in a chunk."""
        if self._letters_are_one and chunk.isascii() and chunk[chunk[0] == " " :].isalpha():
            return [chunk]
        return self.split(chunk)

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        known = self._old.get(chunk)
        if known is None:
            pieces = self.pieces(chunk)
            if len(pieces) == 1:
                known = self.transduce(chunk.encode())
            else:
                young = self._young
                known = tuple(chain.from_iterable([young.get(p) or self._chunk(p) for p in pieces]))
        if len(self._young) >= self.max_chunks:
            self._old, self._young = self._young, {}
        self._young[chunk] = known
        return known

    def _chunks(self, text: str) -> list[str]:
        """Stretches that are encoded apart: those that start at a single blank are independent of each other."""
        if self._odd_space(text):
            return self._units(text)
        head, *rest = text.split(" ")
        return [head, *[" " + c for c in rest]]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text."""
        if not text:
            return []
        chunks = self._chunks(text)
        found = [self._young.get(c) for c in chunks]
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self._young.get(chunks[i]) or self._chunk(chunks[i])
        return list(chain.from_iterable(found))


class Digester:
    """Number, decimal text and decoded bytes of the ids of a text, put together from those of its chunks.

    A chunk is encoded and its ids are decoded when it is met; ``max_chunks`` bounds twice what is remembered.
    """

    def __init__(self, t: BpeTransducer, max_chunks: int):
        self.t, self.max_chunks = t, max_chunks
        self.young: dict[str, tuple[int, bytes, bytes]] = {}
        self.old: dict[str, tuple[int, bytes, bytes]] = {}

    def _entry(self, chunk: str) -> tuple[int, bytes, bytes]:
        known = self.old.get(chunk)
        if known is None:
            pieces = self.t.pieces(chunk)
            if len(pieces) == 1:
                ids = self.t.transduce(chunk.encode())
                machine = Utf8Machine()
                decoded = machine.feed(b"".join([self.t.bytes_of[i] for i in ids])) + machine.end()
                known = (len(ids), b"%d" % ids if len(ids) == 1 else " ".join(map(str, ids)).encode(), decoded.encode())
            else:
                counts, ids, decoded = zip(*[self.young.get(p) or self._entry(p) for p in pieces])
                known = (sum(counts), b" ".join(ids), b"".join(decoded))
        if len(self.young) >= self.max_chunks:
            self.old, self.young = self.young, {}
        if len(chunk) <= LONG_CHUNK:
            self.young[chunk] = known
        return known

    def digests(self, text: str | None) -> tuple[int, str, str]:
        n, ids_sha, text_sha, first = 0, sha256(), sha256(), True
        chunks = [c for c in self.t._chunks(text) if c] if text else []
        get = self.young.get
        for low in range(0, len(chunks), DECODE_PIECE):
            part = chunks[low : low + DECODE_PIECE]
            found = [get(c) for c in part]
            if None in found:
                found = [f or self._entry(c) for f, c in zip(found, part)]
                get = self.young.get
            counts, ids, decoded = zip(*found)
            n += sum(counts)
            ids_sha.update(b" ".join(ids) if first else b" " + b" ".join(ids))
            text_sha.update(b"".join(decoded))
            first = False
        return n, ids_sha.hexdigest(), text_sha.hexdigest()


class Utf8Machine:
    """Incremental UTF-8: feed bytes in any pieces, get text as soon as its bytes are complete.

    The state is the number of bytes that the open character still needs; ill-formed bytes become U+FFFD
    by the replacement rule of the codec.
    """

    def __init__(self) -> None:
        self._open = b""

    @staticmethod
    def _length(lead: int) -> int:
        return 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 1

    def feed(self, data: bytes) -> str:
        if not self._open and data.isascii():
            return data.decode("ascii")
        data = self._open + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 != 0x80:
                if self._length(lead) > back:
                    cut = len(data) - back
                break
        self._open = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self._open = self._open, b""
        return rest.decode("utf-8", "replace")


def decode_stream(bytes_of: dict[int, bytes], pieces: Iterable[list[int]]) -> Iterator[str]:
    """Text of a stream of id lists, piece by piece; a character may be split between pieces."""
    machine = Utf8Machine()
    for ids in pieces:
        yield machine.feed(b"".join(map(bytes_of.__getitem__, ids)))
    yield machine.end()


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def transducer(path: str | None = None, pattern: str | None = None, states: int = MAX_STATES, chunks: int = MAX_CHUNKS, keep: bool = True) -> BpeTransducer:
    """The transducer of a rank file; with ``keep``, built once per Python worker and held as long as that lives.

    The vocabulary is a fixed file of the installation.
    """
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    cache = module_cache("bpe")
    key = (path, pattern, states, chunks)
    found = cache.get(key)
    if found is None:
        with open(path, "rb") as f:
            found = BpeTransducer(read_ranks(f.read()), pattern, states, chunks)
        if keep:
            cache[key] = found
    return found





def bpe_encode(df: DataFrame, text: str = "text", path: str | None = None, ids: str = "ids", n_tokens: str = "n_tokens", states: int = MAX_STATES, chunks: int = MAX_CHUNKS, keep: bool = True) -> DataFrame:
    """The rows with the token ids and their number; ``states`` and ``chunks`` bound what a worker remembers.

    Without ``keep`` a task forgets everything at its end, so stages that follow find the memory free.
    """

    def make():
        t = transducer(path, states=states, chunks=chunks, keep=keep)

        def run(texts):
            with without_collection():
                out = [t.encode(x) for x in texts]
            return [out, [len(x) for x in out]]

        return run

    return append_columns(df, [text], f"`{ids}` array<int>, `{n_tokens}` bigint", make)


def bpe_decode(df: DataFrame, ids: str = "ids", path: str | None = None, decoded: str = "decoded") -> DataFrame:
    """The rows with the text of their ids, decoded piece by piece."""

    def make():
        table = transducer(path).bytes_of

        def run(lists):
            return [["".join(decode_stream(table, (x[i : i + DECODE_PIECE] for i in range(0, len(x), DECODE_PIECE)))) if x else "" for x in lists]]

        return run

    return append_columns(df, [ids], f"`{decoded}` string", make)


def bpe_digests(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """Encodes and decodes every text in one pass and keeps digests: n_tokens, ids_sha256, decoded_sha256."""

    def make():
        digester = Digester(transducer(path), MAX_CHUNKS)

        def run(texts):
            with without_collection():
                return [list(c) for c in zip(*[digester.digests(x) for x in texts])]

        return run

    return append_columns(df, [text], "n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)
