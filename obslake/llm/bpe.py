"""Byte-pair encoding as a streaming transducer with bounded lookahead, and the way back.

Merging is done in the order of the merge list. The encoder reads bytes and emits a token as soon as no later
byte can change it. How far a later byte can reach back is a property of the merge list alone, computed once:

    A difference that starts at the end of what is known moves left only when a merge joins the last agreed
    token u with what follows it, v. What follows then has, on its left edge, the left part of the merge that
    moved the difference before, and that merge stands earlier in the list. So the reach of a merge (u, v) is
    the length of u plus the largest reach of an earlier merge whose left part lies on the left edge of v, and the
    lookahead is the largest reach.

This holds for a list in which every part is a byte or was made earlier, and every token by one merge; for
any other list a word is held until its end. Between words (the pieces of the splitting pattern) nothing is merged.
Memory is one window of a few lookaheads, whatever the text.

Text that is null or empty has no tokens. A special token's string in the text becomes that token, as the library
does by default. Every row is encoded by itself; repeated rows give repeated results.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from obslake.llm.common import batches, texts

#: The splitting pattern of byte-level vocabularies, and the printable stand-ins of bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

CHUNK = 1 << 16  # characters looked at together
CACHED = 400_000  # pieces of text whose tokens a worker remembers: the first it meets, which are the frequent ones


def byte_names() -> dict[str, int]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    rest = [b for b in range(256) if b not in PRINTABLE]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """A merge list over token ids, with its sufficient lookahead."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = byte_names()
        vocab: dict[str, int] = spec["model"]["vocab"]
        as_bytes = lambda s: bytes(names[c] for c in s)
        self.token = {i: as_bytes(s) for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: s.encode() for s, i in self.special.items()}
        by_bytes = {b: i for i, b in self.token.items() if i not in self.special.values()}
        self.of_byte = [by_bytes[bytes([b])] for b in range(256)]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.pairs = [(vocab[u], vocab[v], vocab[u + v]) for u, v in pairs]
        self.merge = {(u, v): (rank, new) for rank, (u, v, new) in enumerate(self.pairs)}
        self.rank = {(u, v): rank for rank, (u, v, _) in enumerate(self.pairs)}
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int | None:
        made = set(self.of_byte)
        left: dict[int, int] = {}  # of each made token: its left part
        reach: dict[int, int] = {}  # of each left part so far: the largest reach of its merges
        for u, v, new in self.pairs:
            if u not in made or v not in made or new in made:
                return None
            t, most = v, reach.get(v, 0)
            while t in left:
                t = left[t]
                most = max(most, reach.get(t, 0))
            reach[u] = max(reach.get(u, 0), len(self.token[u]) + most)
            made.add(new)
            left[new] = u
        return max(reach.values(), default=0)

    def merged(self, data: bytes) -> list[int]:
        """Tokens of a whole word: again and again the earliest merge, wherever it applies, from the left."""
        of_byte, merge = self.of_byte, self.merge
        ids = [of_byte[b] for b in data]
        if len(ids) <= 64:
            return self._merged_short(ids)
        while len(ids) > 1:
            best = None
            for pair in zip(ids, ids[1:]):
                m = merge.get(pair)
                if m is not None and (best is None or m < best):
                    best, where = m, pair
            if best is None:
                break
            (u, v), new, out, i, last = where, best[1], [], 0, len(ids) - 1
            while i < last:
                if ids[i] == u and ids[i + 1] == v:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            if i == last:
                out.append(ids[i])
            ids = out
        return ids


    def _merged_short(self, ids: list[int]) -> list[int]:
        """One merge at a time, the leftmost of the earliest: the same tokens, faster for a short word."""
        rank, pairs = self.rank.get, self.pairs
        none = len(pairs)
        ranks = [rank(pair, none) for pair in zip(ids, ids[1:])]
        while ranks:
            r = min(ranks)
            if r == none:
                break
            i = ranks.index(r)
            ids[i:i + 2] = [pairs[r][2]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), none)
        return ids


class Transducer:
    """Bytes of one word in, tokens out as soon as they are stable."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.window = b""
        self.room = 4 * (merges.lookahead or 0)

    def feed(self, data: bytes) -> list[int]:
        self.window += data
        if self.merges.lookahead is None or len(self.window) <= self.room:
            return []
        out: list[int] = []
        done, size = 0, 2 * self.room
        while len(self.window) - done > self.room:
            part = self.window[done:done + size]
            stable, at = len(part) - self.merges.lookahead, 0
            for t in self.merges.merged(part):
                at += len(self.merges.token[t])
                if at > stable:
                    break
                out.append(t)
                done += len(self.merges.token[t])
        self.window = self.window[done:]
        return out

    def finish(self) -> list[int]:
        out, self.window = self.merges.merged(self.window), b""
        return out


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Text to little-endian 32-bit ids, remembering the ids of frequent pieces."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.split = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(merges.special, key=len, reverse=True)) or r"(?!)")
        self.runs = {k: regex.compile(p) for k, p in (("L", r"\p{L}+"), ("N", r"\p{N}+"), ("O", r"[^\s\p{L}\p{N}]+"), ("S", r"\s+"))}
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    # - a piece of text between safe places

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            data = word.encode()
            if len(data) <= 64:  # within the first window: all of it is stable at its end
                ids = packed(self.merges.merged(data))
            else:
                through = Transducer(self.merges)
                ids = packed(through.feed(data) + through.finish())
            if len(word) <= 64 and len(self.words) < CACHED:
                self.words[word] = ids
        return ids

    def _split_words(self, text: str) -> bytes:
        return b"".join(map(self._word, self.split.findall(text)))

    def _piece(self, text: str) -> bytes:
        """A stretch of text that no word of the pattern crosses at either end.

        A blank between two other characters always starts a word, so what stands between such blanks is
        remembered as a whole. Other white space around a blank can join it: then the whole stretch is split.
        """
        first, *rest = text.split(" ")
        known = list(map(self.pieces.get, rest))
        if None in known:
            for i, ids in enumerate(known):
                if ids is None:
                    piece = rest[i]
                    if not piece or piece[0].isspace():
                        return self._split_words(text)
                    known[i] = ids = self._split_words(" " + piece)
                    if len(piece) <= 64 and len(self.pieces) < CACHED:
                        self.pieces[piece] = ids
        return self._split_words(first) + b"".join(known)

    # - whole texts

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of ``text``, a chunk at a time."""
        at = 0
        for m in self.specials.finditer(text):
            yield from self._plain(text, at, m.start())
            yield packed([self.merges.special[m[0]]])
            at = m.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, at: int, end: int) -> Iterator[bytes]:
        while end - at > CHUNK:
            cut = text.rfind(" ", at + 1, at + CHUNK)
            while cut > at and (text[cut - 1].isspace() or text[cut + 1].isspace()):
                cut = text.rfind(" ", at + 1, cut)
            if cut <= at:  # no safe place near: character runs of any length go through in windows
                yield from self.stream(text[i:min(i + CHUNK, end)] for i in range(at, end, CHUNK))
                return
            yield self._piece(text[at:cut])
            at = cut
        if at < end:
            yield self._piece(text[at:end])

    def stream(self, chunks: Iterable[str]) -> Iterator[bytes]:
        """Ids of the text that the chunks make up, without special tokens; memory does not grow with any word."""
        held, kind, through = "", None, Transducer(self.merges)
        for chunk in chunks:
            held += chunk
            if kind:  # inside a long run: what continues it is fed at once
                m = self.runs[kind].match(held)
                n = m.end() if m else 0
                if kind == "S":
                    ended = n < len(held)
                    n = max(0, n - 1)  # the last blank may belong to what follows
                else:
                    ended = n < len(held)
                yield packed(through.feed(held[:n].encode()))
                held = held[n:]
                if not ended:
                    continue
                yield packed(through.finish())
                kind = None
            words = self.split.findall(held)
            # the last two words may still change; a word that fills the chunk is a run and goes on being fed
            keep, last = 0, words[-2:]
            ready = words[:-2]
            yield b"".join(map(self._word, ready))
            keep = sum(map(len, last))
            held = held[len(held) - keep:] if keep else ""
            if last and len(last[-1]) > CHUNK // 4:
                for w in last[:-1]:
                    yield self._word(w)
                run = last[-1]
                kind = next(k for k, r in self.runs.items() if r.match(run[-1]))
                n = len(run) - (kind == "S")
                yield packed(through.feed(run[:n].encode()))
                held = run[n:]
        if kind:
            yield packed(through.feed(held.encode()) + through.finish())
        else:
            yield b"".join(map(self._word, self.split.findall(held)))


class Decoder:
    """Ids to text a chunk at a time: bytes of a character may come from several tokens and chunks."""

    def __init__(self, merges: Merges) -> None:
        self.token = merges.token
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: bytes) -> str:
        return self.state.decode(b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist())))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(Merges(path))


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per row: number of tokens, digest of its ids, digest of the text decoded from them."""

    def run(it):
        enc = encoder(path)
        for batch in it:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids, back, n, decode = hashlib.sha256(), hashlib.sha256(), 0, Decoder(enc.merges)
                for part in enc.encode(text.as_py()):
                    n += len(part) // 4
                    ids.update(part)
                    back.update(decode.feed(part).encode())
                back.update(decode.finish().encode())
                rows.append((doc_id, n, ids.hexdigest(), back.hexdigest()))
            yield from batches(rows, _DIGESTS, 10_000)

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Per row: ``doc_id`` and its whole ``ids``."""

    def run(it):
        enc = encoder(path)
        for batch in it:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = np.frombuffer(b"".join(enc.encode(text.as_py())), "<u4").astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([ids], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Per row of (doc_id, ids): ``doc_id`` and the decoded ``text``; null ids count as none."""

    def run(it):
        merges = encoder(path).merges
        for batch in it:
            rows = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), batch["ids"], strict=True):
                state = Decoder(merges)
                values = np.asarray(ids.values, "<u4") if ids.is_valid else np.empty(0, "<u4")
                rows.append((doc_id, state.feed(values.tobytes()) + state.finish()))
            yield from batches(rows, pa.schema([("doc_id", pa.int64()), ("text", pa.string())]), 1000)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
