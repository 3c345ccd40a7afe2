"""Byte-level BPE as a streaming transducer with bounded lookahead, and its decoder.

The encoder never holds more than a window of text: pretokens are cut off as
soon as no later character can change them, and the tokens of a pretoken that
is longer than the window are emitted once no later byte can change them. How
many bytes that takes follows from the merge list alone
(:func:`sufficient_lookahead`). Pure Python, no Spark.
"""

from __future__ import annotations

import base64
import codecs
import json
from collections.abc import Iterable, Iterator
from functools import cache

import regex

#: The public byte-level pattern: contractions, letters, digits, other signs, spaces (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters after a pretoken that can still change it: a contraction is three long.
TEXT_LOOKAHEAD = 4
#: Characters of text that are looked at together; a longer run streams through :class:`ByteStream`.
CHUNK = 1 << 15
#: Words up to this many bytes are remembered, up to so many of them.
CACHED_BYTES, CACHED_WORDS = 64, 300_000


@cache
def byte_signs() -> dict[str, int]:
    """The printable sign of each byte in byte-level vocabularies, by rule: printable Latin-1 as itself, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a token's end beyond which no byte can change that the token ends there.

    Merge ``i`` of ``u`` and ``v`` can only be thwarted from the right by an
    earlier merge that takes a piece from the right edge of ``v`` (or of ``u``,
    across ``v``) away to its own right side. That merge can in turn be
    thwarted by still earlier ones. The longest such chain, in bytes, is
    found by one pass over the merges in order: ``reach[s]`` is how far to the
    right of ``s`` the merges with left side ``s`` seen so far can depend on.
    """
    right: dict[bytes, bytes] = {}
    reach: dict[bytes, int] = {}
    most = 0

    def edge(t: bytes) -> Iterator[bytes]:
        yield t
        while t in right:
            t = right[t]
            yield t

    for u, v in merges:
        far = max((reach.get(s, 0) for s in edge(v)), default=0)
        far = max(far, max((reach.get(s, 0) - len(v) for s in edge(u)), default=0))
        most = max(most, far + len(v))
        reach[u] = max(reach.get(u, 0), far + len(v))
        right.setdefault(u + v, v)
    return most


class Bpe:
    """A vocabulary with its merge order."""

    def __init__(self, ids: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> None:
        self.ids = ids
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.lookahead = sufficient_lookahead(merges)
        self.longest = max(map(len, ids), default=1)
        self.bytes_of = {i: b for b, i in ids.items()}
        self._words: dict[str, tuple[int, ...]] = {}
        self._signs = [ids[bytes([b])] for b in range(256)]

    @classmethod
    def from_file(cls, path: str) -> Bpe:
        """A ``tokenizers`` JSON file of a byte-level BPE, or a ``tiktoken`` file of ranks."""
        if path.endswith(".tiktoken"):
            ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
            return cls(ids, _merges_of_ranks(ids))
        model = json.load(open(path, encoding="utf-8"))["model"]
        signs = byte_signs()
        raw = lambda s: bytes(signs[c] for c in s)
        ids = {raw(s): i for s, i in model["vocab"].items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        return cls(ids, [(raw(a), raw(b)) for a, b in pairs])

    def merge(self, data: bytes) -> list[bytes]:
        """All merges over a bounded stretch, lowest rank first, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks, none = self.ranks, 1 << 60
        if len(parts) > 48:
            return self._merge_long(parts)
        while len(parts) > 1:
            best, at = none, -1
            for i in range(len(parts) - 1):
                r = ranks.get((parts[i], parts[i + 1]), none)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merge_long(self, parts: list[bytes]) -> list[bytes]:
        """The same with a heap over a linked list, for stretches of the window's size."""
        import heapq

        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        cells: list[bytes | None] = list(parts)
        ranks = self.ranks
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if cells[i] != a or j >= n or cells[j] != b:
                continue
            cells[i], cells[j] = a + b, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0 and (r := ranks.get((cells[before[i]], a + b))) is not None:
                heapq.heappush(heap, (r, before[i], cells[before[i]], a + b))
            if after[i] < n and (r := ranks.get((a + b, cells[after[i]]))) is not None:
                heapq.heappush(heap, (r, i, a + b, cells[after[i]]))
        return [c for c in cells if c is not None]

    def word(self, text: str) -> tuple[int, ...]:
        """The ids of one bounded pretoken; short ones are remembered."""
        found = self._words.get(text)
        if found is None:
            data = text.encode("utf-8", "surrogatepass")
            stream = ByteStream(self)
            found = tuple([*stream.push(data), *stream.finish()])
            if len(data) <= CACHED_BYTES:
                if len(self._words) >= CACHED_WORDS:
                    self._words.clear()
                self._words[text] = found
        return found

    def encode(self, text: str | None) -> list[int]:
        """All ids of a text, without special tokens; none for an empty or NULL text."""
        out: list[int] = []
        if text:
            encoder = Encoder(self)
            for i in range(0, len(text), CHUNK):
                encoder.push(text[i : i + CHUNK], out)
            encoder.finish(out)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        decoder = Decoder(self)
        return "".join([*(decoder.push(i) for i in ids), decoder.finish()])


def _merges_of_ranks(ids: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The merge that made each token: its last two parts when only lower ranks merge."""
    merges = []
    for token, rank in sorted(ids.items(), key=lambda kv: kv[1]):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ids.get(parts[i] + parts[i + 1], 1 << 60))
            if ids.get(parts[best] + parts[best + 1], 1 << 60) >= rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            merges.append((parts[0], parts[1]))
    return merges


class ByteStream:
    """Bytes of one pretoken in, ids out as soon as they are stable.

    The window is merged as a whole. Tokens that end at least ``lookahead``
    bytes before its end stay as they are whatever follows, so they go out, and
    merging goes on from the last of their ends.
    """

    def __init__(self, bpe: Bpe) -> None:
        self.bpe = bpe
        self.window = 4 * max(bpe.lookahead + bpe.longest, 256)
        self.pending = b""

    def push(self, data: bytes) -> list[int]:
        out: list[int] = []
        self.pending += data
        while len(self.pending) >= self.window:
            head, end, stable = self.pending[: self.window], 0, self.window - self.bpe.lookahead
            for token in self.bpe.merge(head):
                if end + len(token) > stable:
                    break
                end += len(token)
                out.append(self.bpe.ids[token])
            self.pending = self.pending[end:]
        return out

    def finish(self) -> list[int]:
        rest, self.pending = self.pending, b""
        return [self.bpe.ids[t] for t in self.bpe.merge(rest)]


_RX = regex.compile(PATTERN)
#: What continues a run of each kind.
_RUNS = {"L": regex.compile(r"\p{L}+"), "N": regex.compile(r"\p{N}+"), "O": regex.compile(r"[^\s\p{L}\p{N}]+")}
_SPACES = regex.compile(r"\s+")


class Encoder:
    """Text in pieces, ids out. State: an unfinished tail, and the open run if it outgrew a chunk."""

    def __init__(self, bpe: Bpe) -> None:
        self.bpe = bpe
        self.tail = ""
        self.run: tuple[str, ByteStream] | None = None

    def push(self, text: str, out: list[int]) -> None:
        self._take(text, out, last=False)

    def finish(self, out: list[int]) -> None:
        self._take("", out, last=True)

    def _take(self, text: str, out: list[int], last: bool) -> None:
        text = self.tail + text
        self.tail = ""
        start = 0
        if self.run:
            kind, stream = self.run
            if kind == "S":
                start = self._spaces(text, stream, out, last)
            else:
                m = _RUNS[kind].match(text)
                start = m.end() if m else 0
                out += stream.push(text[:start].encode("utf-8", "surrogatepass"))
                if start < len(text) or last:
                    out += stream.finish()
                    self.run = None
            if self.run:
                return
        limit = len(text) if last else len(text) - TEXT_LOOKAHEAD
        word = self.bpe.word
        known = self.bpe._words.get
        for m in _RX.finditer(text, start):
            end = m.end()
            if end > limit and not last:
                break
            w = m.group()
            out += known(w) or word(w)
            start = end
        if last:
            return
        rest = text[start:]
        if len(rest) >= CHUNK:
            self._open(rest, out)
        else:
            self.tail = rest

    def _open(self, rest: str, out: list[int]) -> None:
        """A pretoken fills the whole chunk: go on within its kind."""
        body = rest[1:] if rest[0] == " " and not rest[1].isspace() else rest
        stream = ByteStream(self.bpe)
        if _SPACES.match(body):
            self.run = ("S", stream)
            self._take(rest, out, last=False)
            return
        kind = next(k for k, rx in _RUNS.items() if rx.match(body))
        out += stream.push(rest[: len(rest) - len(body)].encode())
        self.run = (kind, stream)
        self._take(body, out, last=False)

    def _spaces(self, text: str, stream: ByteStream, out: list[int], last: bool) -> int:
        """Spaces run on; the last one before other text belongs to what follows."""
        m = _SPACES.match(text)
        end = m.end() if m else 0
        if end == len(text) and not last:
            keep = max(end - 1, 0)
            out += stream.push(text[:keep].encode("utf-8", "surrogatepass"))
            self.tail = text[keep:]
            return keep
        cut = end if last and end == len(text) else max(end - 1, 0)
        out += stream.push(text[:cut].encode("utf-8", "surrogatepass"))
        out += stream.finish()
        self.run = None
        return cut


class Decoder:
    """Ids in, text out as soon as its bytes make up whole characters."""

    def __init__(self, bpe: Bpe, errors: str = "strict") -> None:
        self.bytes_of = bpe.bytes_of
        self.machine = codecs.getincrementaldecoder("utf-8")(errors)

    def push(self, token: int) -> str:
        return self.machine.decode(self.bytes_of[token])

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)


@cache
def load(path: str) -> Bpe:
    """One vocabulary per worker process."""
    return Bpe.from_file(path)
