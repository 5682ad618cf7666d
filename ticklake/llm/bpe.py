"""Byte-level BPE encoding and decoding by stable pairs of tokens.

For every byte prefix of a piece there is exactly one token that can end its
encoding: token t may follow the last token p of the shorter prefix iff the
two form a stable pair, that is iff merging the bytes of p and t gives p and
t again.  So an encoding is a table with one token for each prefix, filled
left to right from the tokens that an Aho-Corasick automaton finds ending
there, and read back from the end.  Two things follow: appending bytes only
extends the table, and after an edit only the rows from the edit on are filled
again, until they agree with the old ones.

A piece that is encoded once needs only one path through that table: from the
start the longest token that fits the one before is taken, and where none does
the last is given up for a shorter one.  A place from which no path reaches the
end is not entered again, so the work stays in proportion to the piece.

The text is cut into pieces by a pattern first (each piece is encoded alone);
pieces of natural text repeat, so tasks remember the encodings of short ones.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import handing_back, kept_by_operator, trim

#: Characters of look-ahead by which the pattern may decide on a piece's end.
LOOKAHEAD = 3
#: Short pieces that a task remembers; memory only, results are the same.
REMEMBERED, REMEMBERED_CHARS = 250_000, 64
#: Pairs of tokens that it remembers.
PAIRS = 500_000


def read_ranks(path: str) -> bytes:
    """The rank file (a base64 token and its rank on each line) as it is."""
    with open(path, "rb") as f:
        return f.read()


class _Remembered(dict):
    """A dictionary that computes absent entries, in two generations: when the
    new one is full the one before goes, and what is met again moves on."""

    def __init__(self, compute, key_fits=lambda key: True, most=REMEMBERED):
        super().__init__()
        self.compute, self.key_fits, self.most, self.before = compute, key_fits, most, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
        if self.key_fits(key):
            if 2 * len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[key] = value
        return value

    def forget(self) -> None:
        self.before = {}
        self.clear()


class Bpe:
    """Tokens and pair rules of one rank file."""

    def __init__(self, rank_file: bytes, pattern: str):
        pairs = (line.split() for line in rank_file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.text_of = {rank: str(rank) for rank in self.bytes_of}
        self.pattern = regex.compile(pattern)
        self.ending, self.whole = ahocorasick.Automaton(), {}
        halves: dict[bytes, tuple[bytes, bytes]] = {}  # what a token's last merge joins
        for token, rank in self.ranks.items():
            if len(token) == 1 or (parts := self._parts(token, 2)) and b"".join(parts) in self.ranks and len(parts) == 2:
                if len(token) > 1:
                    halves[token] = (parts[0], parts[1])
                self.ending.add_word(token.decode("latin-1"), (rank, len(token)))
                self.whole[token.decode("latin-1")] = (rank,)  # others no encoding can contain
        self.ending.make_automaton()
        self.halves = halves
        # the rule of _follows needs parts that are merged before what they are part of
        self.ordered = all(len(h) == 1 or self.ranks[h] < self.ranks[token] for token, parts in halves.items() for h in parts)
        self.edges = _Remembered(self._edge)
        self.longest = max(map(len, self.ranks))
        self.has_bytes = all(bytes([b]) in self.ranks for b in range(256))  # else some texts have no encoding
        self.stable = _Remembered(self._follows, most=PAIRS)
        self.known = _Remembered(self._piece, lambda piece: len(piece) <= REMEMBERED_CHARS)
        self.piece = self.known.__getitem__

    def _parts(self, data: bytes, least: int = 1) -> list[bytes]:
        """The encoding by its definition: join the adjacent parts of lowest
        rank, the first of equals, until no two adjacent parts are a token (or
        `least` parts are left)."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least:
            found = [(self.ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in self.ranks]
            if not found:
                break
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _edge(self, key: tuple[int, bool]) -> list[tuple[bytes, float]]:
        """The parts of a token that are at its end (or its start), from a
        single byte to the whole, each with the rank of the merge that ends it."""
        token, at_end = self.bytes_of[key[0]], key[1]
        out, until = [], float("inf")
        while True:
            out.append((token, until))
            if len(token) == 1:
                return out[::-1]
            until = self.ranks[token]
            token = self.halves[token][at_end]

    def _follows(self, pair: tuple[int, int]) -> bool:
        """Whether the two tokens may stand next to each other: while both are
        built, no part at the end of the first and part at the start of the
        second that stand side by side may be joined before either is joined
        inside its own token.  Of equal ranks the left is joined first."""
        if not self.ordered:
            data = self.bytes_of[pair[0]] + self.bytes_of[pair[1]]
            return [self.ranks[x] for x in self._parts(data)] == [*pair]
        left, right = self.edges[pair[0], True], self.edges[pair[1], False]
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = left[i], right[j]
            joined = self.ranks.get(a + b)
            if joined is not None and joined < a_until and joined <= b_until:
                return False
            if a_until <= b_until:
                i += 1
                if i == len(left):  # both are whole
                    return True
            else:
                j += 1

    def extend(self, data: str, last: list[int], start: int) -> Iterator[int]:
        """Fill `last` (of the prefixes of `data`, bytes as latin-1) from
        prefix length `start` + 1 on; yields each length filled.  last[n - 1]
        is the last token of the prefix of n bytes."""
        del last[start:]
        filled, stable = start, self.stable
        for end, (token, size) in self.ending.iter(data, max(0, start - self.longest)):
            if end >= filled:  # else this prefix has its token
                at = end + 1 - size
                if not at or stable[last[at - 1], token]:
                    last.append(token)
                    filled = end + 1
                    yield filled

    def forget(self) -> None:
        """Free what has been remembered: workers live on after a task."""
        for remembered in (self.known, self.stable, self.edges):
            remembered.forget()

    def tokens(self, last: list[int]) -> list[int]:
        out, end, bytes_of = [], len(last), self.bytes_of
        while end:
            out.append(token := last[end - 1])
            end -= len(bytes_of[token])
        return out[::-1]

    def _piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode().decode("latin-1")
        if whole := self.whole.get(data):
            return whole
        if self.has_bytes:
            return tuple(self._path(data))
        last: list[int] = []
        for _ in self.extend(data, last, 0):
            pass
        return tuple(self.tokens(last))

    def _path(self, data: str) -> list[int]:
        """The only sequence of tokens of `data` (bytes as latin-1) whose
        neighbours all are stable pairs, the longest tokens tried first."""
        whole, stable, reach, longest = self.whole, self.stable, self.ending.longest_prefix, self.longest
        out: list[int] = []
        sizes: list[int] = []
        dead: set[int] = set()
        at, n = 0, len(data)
        size = reach(data[:longest])
        while at < n:
            while size:
                token = whole.get(data[at : at + size])
                if token is not None and at + size not in dead and (not out or stable[out[-1], token[0]]):
                    break
                size -= 1
            if size:
                out.append(token[0])
                sizes.append(size)
                at += size
                size = reach(data[at : at + longest])
            else:
                dead.add(at)
                out.pop()
                at -= sizes[-1]
                size = sizes.pop() - 1
        return out

    def pieces(self, text: str, window: int = 1 << 20) -> Iterator[list[str]]:
        """The pattern's matches in order, in blocks; a long text is matched
        in windows, keeping only matches that their window's end can't touch."""
        at, width = 0, window
        while at < len(text):
            end = min(at + width, len(text))
            found = self.pattern.findall(text, at, end)
            if end < len(text):
                spare = 0
                while found and spare < LOOKAHEAD:
                    spare += len(found.pop())
            if found:
                yield found
                at, width = at + sum(map(len, found)), window
            else:
                width *= 2

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(chain.from_iterable(map(self.piece, block) for block in self.pieces(text))))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class LiveEncoding:
    """The encoding of one text that changes: appends and edits give the same
    tokens as encoding the new text afresh, and redo only what they touch."""

    def __init__(self, bpe: Bpe, text: str = ""):
        self.bpe, self.text = bpe, ""
        self.cuts: list[str] = []  # pieces
        self.tables: list[list[int]] = []  # their prefix tables
        self.redone = 0  # prefixes filled by the last change
        self.edit(0, 0, text)

    def append(self, text: str) -> None:
        self.edit(len(self.text), len(self.text), text)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace text[start:end] by `new`."""
        self.redone, old, shift = 0, self.text, len(new) - (end - start)
        self.text = old[:start] + new + old[end:]
        keep, at = 0, 0
        while keep < len(self.cuts) and at + len(self.cuts[keep]) + LOOKAHEAD <= start:
            at += len(self.cuts[keep])
            keep += 1
        ends, pos = {}, at  # where the old pieces behind the edit begin
        for i in range(keep, len(self.cuts)):
            ends[pos] = i
            pos += len(self.cuts[i])
        cuts, tables, rest = [], [], len(self.cuts)
        while at < len(self.text):
            i = ends.get(at - shift) if at >= start + len(new) else None
            if i is not None:  # from here on the pieces are the old ones
                rest = i
                break
            piece = self.bpe.pattern.match(self.text, at).group()
            before = keep + len(cuts)
            known = before < len(self.cuts) and at < start + len(new) + LOOKAHEAD
            cuts.append(piece)
            tables.append(self._table(piece, self.cuts[before], self.tables[before]) if known else self._table(piece, "", []))
            at += len(piece)
        self.cuts[keep:rest], self.tables[keep:rest] = cuts, tables

    def _table(self, piece: str, old: str, old_table: list[int]) -> list[int]:
        """The table of `piece`: it starts with the prefixes it shares with an
        old piece, and ends with the old rows once as many rows as the longest
        token has bytes agree and the rest of the bytes is the same."""
        a, b = piece.encode(), old.encode()
        shared = 0
        while shared < min(len(a), len(b)) and a[shared] == b[shared]:
            shared += 1
        back = 0
        while back < min(len(a), len(b)) - shared and a[-1 - back] == b[-1 - back]:
            back += 1
        last, moved, alike = list(old_table[:shared]), len(a) - len(b), 0
        for n in self.bpe.extend(a.decode("latin-1"), last, shared):
            self.redone += 1
            behind = n > len(a) - back
            alike = alike + 1 if behind and old_table[n - 1 - moved] == last[-1] else 0
            if alike >= self.bpe.longest:
                last.extend(old_table[n - moved :])
                break
        return last

    def ids(self) -> list[int]:
        return list(chain.from_iterable(map(self.bpe.tokens, self.tables)))


@kept_by_operator
@lru_cache(maxsize=2)
def bpe_of(rank_file: bytes, pattern: str) -> Bpe:
    """One automaton for each worker process and rank file."""
    bpe = Bpe(rank_file, pattern)
    trim()
    return bpe


def _digest(bpe: Bpe, text: str) -> tuple[int, str, str]:
    """Token count, SHA-256 of the ids and of the bytes that they decode to;
    a long text is taken in blocks of pieces."""
    n, ids_hash, bytes_hash = 0, hashlib.sha256(), hashlib.sha256()
    for block in bpe.pieces(text):
        ids = list(chain.from_iterable(map(bpe.piece, block)))
        ids_hash.update(("," * (n > 0) + ",".join(map(bpe.text_of.__getitem__, ids))).encode())
        bytes_hash.update(bpe.decode(ids))
        n += len(ids)
    return n, ids_hash.hexdigest(), bytes_hash.hexdigest()


def _rank_broadcast(df: DataFrame, rank_path: str):
    return df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))  # the vocabulary: under 1 MB


def bpe_digests(docs: DataFrame, text: str, rank_path: str, pattern: str) -> DataFrame:
    """`docs` with n_tokens, ids_sha256 and decoded_sha256 of each text (the
    decoded bytes come from the ids).  A null text counts as empty: no tokens,
    the digests of nothing.  Rows are independent: no shuffle, repeated rows
    are kept.  Columns of these names are replaced."""
    ranks = _rank_broadcast(docs, rank_path)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    @handing_back
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = bpe_of(ranks.value, pattern)
        for texts in batches:
            rows = [_digest(bpe, x or "") for x in texts]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        bpe.forget()

    names = ("n_tokens", "ids_sha256", "decoded_sha256")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    out = docs.select(*kept, digest(F.col(text)).alias("__bpe"))
    return out.select(*kept, *[F.col("__bpe")[n].alias(n) for n in names])


def encoded(docs: DataFrame, text: str, rank_path: str, pattern: str, into: str = "token_ids") -> DataFrame:
    """`docs` with the token ids of each text (array<int>; null: empty)."""
    ranks = _rank_broadcast(docs, rank_path)

    @F.pandas_udf("array<int>")
    @handing_back
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = bpe_of(ranks.value, pattern)
        for texts in batches:
            yield pd.Series([bpe.encode(x or "") for x in texts])
        bpe.forget()

    return docs.withColumn(into, encode(F.col(text)))


def decoded(docs: DataFrame, ids: str, rank_path: str, pattern: str, into: str = "decoded") -> DataFrame:
    """`docs` with the text of an id column (null: empty).  Bytes that end in
    the middle of a character are replaced, as for a cut-off encoding."""
    ranks = _rank_broadcast(docs, rank_path)

    @F.pandas_udf("string")
    @handing_back
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = bpe_of(ranks.value, pattern)
        for lists in batches:
            yield pd.Series([bpe.decode(x if x is not None else ()).decode(errors="replace") for x in lists])

    return docs.withColumn(into, decode(F.col(ids)))


__all__ = ["Bpe", "LiveEncoding", "bpe_digests", "decoded", "encoded", "read_ranks"]
