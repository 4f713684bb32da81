"""Byte-level BPE as a tree of joins, exact for rank files of the tiktoken form.

Encodings form a monoid under ``join``: the tokens of two neighbouring byte strings give
those of their concatenation. A long string is encoded by its halves, recursively, and a
join re-encodes a window around the seam, which grows until the tokens outside are proven
stable. The proof is local: a token sequence is the encoding of its bytes if and only if
every two neighbours are, i.e. their bytes together encode to just these two. Both sides
are encodings already, so only the two pairs at the window's ends need the test. Leaves
are encoded by the same rule: there is just one sequence whose neighbours all fit.

The same scheme splits text by the pattern. Matches near the end of the left half may have
looked beyond it; from the first of these the text is matched again until a match ends
where one of the right half's begins, from where on both agree, as the pattern never looks
back. ``decode`` concatenates up the tree.

Words repeat, so encodings of matches are kept in a memo of bounded size.

Defined cases: a null text is empty; an empty text has no tokens; texts of any length are
encoded whole.
"""

from __future__ import annotations

import base64
import heapq
import math
import uuid
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Bytes encoded directly, characters matched directly, and entries in one half of a memo.
LEAF_BYTES, LEAF_CHARS, MEMO = 32, 8192, 250_000
#: No alternative of the pattern needs more than this many characters from its start, or
#: one beyond its end, to be certain of its match.
LOOK_AHEAD = 3


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Memo(dict):
    """Results by key; about the last ``size`` to ``2 * size`` used ones are kept."""

    def __init__(self, compute: Callable, size: int = MEMO):
        super().__init__()
        self.compute, self.size, self.older = compute, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.table = np.full(max(self.tokens, default=-1) + 1, b"", dtype=object)
        for rank, token in self.tokens.items():
            self.table[rank] = token
        self.fits = Memo(self._fits)
        self.edges = Memo(self._edges, len(ranks))
        self.longest = max(map(len, ranks), default=1)
        self.packed = Memo(lambda match: array("i", self.of_match(match.encode())).tobytes())

    def _edges(self, token: int) -> tuple[list[tuple[bytes, float]], list[tuple[bytes, float]]]:
        """What stands at the token's left and right end while it is merged, from the single
        byte to the token itself, each with the rank of the merge that ends it."""
        data = self.tokens[token]
        parts = [data[i : i + 1] for i in range(len(data))]
        left, right = [], []
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, math.inf) for a, b in zip(parts, parts[1:])]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if at == 0:
                left.append((parts[0], ranks[at]))
            if at == len(ranks) - 1:
                right.append((parts[-1], ranks[at]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [*left, (data, math.inf)], [*right, (data, math.inf)]

    def _fits(self, pair: tuple[int, int]) -> bool:
        """Whether the tokens' bytes together encode to just these two.

        They do unless, at some time, what stands at both sides of the seam merges: by a
        rank below that of the left side's next merge, and not above the right side's, as
        of equal ranks the leftmost comes first.
        """
        ends, begins = self.edges[pair[0]][1], self.edges[pair[1]][0]
        i = j = 0
        while True:
            (a, until_a), (b, until_b) = ends[i], begins[j]
            rank = self.ranks.get(a + b)
            if rank is not None and rank < until_a and rank <= until_b:
                return False
            if until_a <= until_b:
                i += 1
            else:
                j += 1
            if i == len(ends) or j == len(begins):
                return True

    def leaf(self, data: bytes) -> tuple[int, ...]:
        """The only sequence of tokens for ``data`` of which every two neighbours fit.

        Longest tokens are tried first; where none fits, the token before is shortened.
        """
        get, fits, n = self.ranks.get, self.fits, len(data)
        out, starts, at, end = [], [], 0, min(n, self.longest)
        while at < n:
            while end > at:
                token = get(data[at:end])
                if token is not None and (not out or fits[out[-1], token]):
                    break
                end -= 1
            if end > at:
                out.append(token)
                starts.append(at)
                at, end = end, min(n, end + self.longest)
            else:
                out.pop()
                end, at = at - 1, starts.pop()
        return tuple(out)

    def merged(self, data: bytes) -> tuple[int, ...]:
        """The tokens by the definition: merge the lowest rank, the leftmost first."""
        ranks, n = self.ranks, len(data)
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n

        def candidate(i: int):
            j = after[i]
            rank = ranks.get(data[i : end[j]]) if j < n else None
            return None if rank is None else (rank, i, end[i], end[j])

        heap = [c for c in map(candidate, range(n)) if c]
        heapq.heapify(heap)
        while heap:
            _, i, mid, stop = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or end[i] != mid or j >= n or end[j] != stop:
                continue
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (i, before[i]):
                if k >= 0 and (c := candidate(k)):
                    heapq.heappush(heap, c)
        return tuple(ranks[data[i : end[i]]] for i in range(n) if alive[i])

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The tokens of both sides' bytes together."""
        i = j = 1
        while left and right:
            window = b"".join(map(self.tokens.__getitem__, left[-i:] + right[:j]))
            window = self.leaf(window) if len(window) <= LEAF_BYTES else self.merged(window)
            starts = i >= len(left) or self.fits[left[-i - 1], window[0]]
            ends = j >= len(right) or self.fits[window[-1], right[j]]
            if starts and ends:
                return left[:-i] + window + right[j:]
            i, j = i if starts else 2 * i, j if ends else 2 * j
        return left + right

    def of_bytes(self, data: bytes) -> tuple[int, ...]:
        if len(data) <= LEAF_BYTES:
            return self.leaf(data)
        # Runs of one character split evenly at powers of two.
        half = 1 << (len(data) - 1).bit_length() - 1
        return self.join(self.of_bytes(data[:half]), self.of_bytes(data[half:]))

    def of_match(self, data: bytes) -> tuple[int, ...]:
        """A match that is a token stays one, as in the library whose files these are."""
        rank = self.ranks.get(data)
        return (rank,) if rank is not None else self.of_bytes(data)

    def matches(self, text: str) -> list[str]:
        if len(text) <= LEAF_CHARS:
            return self.pattern.findall(text)
        half = 1 << (len(text) - 1).bit_length() - 1
        return self._seamed(self.matches(text[:half]), self.matches(text[half:]))

    def _seamed(self, left: list[str], right: list[str]) -> list[str]:
        """The matches of both sides' characters together."""
        open_, length = [], 0
        while left and (not open_ or length + len(left[-1]) < LOOK_AHEAD):
            open_.append(left.pop())
            length += len(open_[-1])
        seam, taken = "".join(reversed(open_)), 8
        while True:
            window = seam + "".join(right[:taken])
            whole = taken >= len(right)
            starts, at = {}, len(seam)
            for k, match in enumerate(right[:taken]):
                starts[at] = k
                at += len(match)
            found, at = [], 0
            for match in self.pattern.findall(window):
                if at in starts:
                    return left + found + right[starts[at] :]
                if not whole and (at + len(match) + 1 > len(window) or at + LOOK_AHEAD > len(window)):
                    break
                found.append(match)
                at += len(match)
            else:
                return left + found + right[taken:]
            taken *= 2

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, self.matches(text)))

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF_CHARS:
            return b"".join(self.table[ids].tolist())
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


#: The last coder of a worker process, so that later tasks find its memos.
_CODERS: dict[tuple[str, str], Bpe] = {}


class Tokenizer:
    """Column functions of one vocabulary.

    The rank file is read where the job is built and handed to the tasks; it has a fixed
    number of entries, whatever the data.
    """

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str):
        self.ranks, self.pattern = spark.sparkContext.broadcast(read_ranks(ranks_path)), pattern
        self.key = (uuid.uuid4().hex, pattern)

    def _coder(self) -> Callable[[], Bpe]:
        ranks, key = self.ranks, self.key

        def coder() -> Bpe:
            if key not in _CODERS:
                _CODERS.clear()
                _CODERS[key] = Bpe(ranks.value, key[1])
            return _CODERS[key]

        return coder

    def encode(self, text: Column) -> Column:
        """array<int> of a text."""
        coder = self._coder()

        @F.arrow_udf("array<int>")
        def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            bpe = coder()
            for batch in batches:
                rows = [bpe.encode(text.as_py() or "") for text in batch]
                ends = np.cumsum([0, *(len(row) // 4 for row in rows)], dtype=np.int32)
                values = np.frombuffer(b"".join(rows), dtype=np.int32)
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=pa.int32()))

        return encoded(text)

    def decode(self, ids: Column) -> Column:
        """binary of the bytes that the ids stand for."""
        coder = self._coder()

        @F.arrow_udf("binary")
        def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            bpe = coder()
            for batch in batches:
                values, ends = batch.values.to_numpy(), batch.offsets.to_pylist()
                # A null row has no values of its own.
                yield pa.array([bpe.decode(values[a:b]) for a, b in zip(ends, ends[1:])], type=pa.binary())

        return decoded(ids)
