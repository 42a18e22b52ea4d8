"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A rolling hash cuts texts where their content says so, hence copies and shared
passages fall into equal chunks wherever they stand. One pass counts the chunk
digests of all texts; chunks that occur twice or more are worth keeping, and a
worker encodes such a chunk once. A chunk knows nothing of its neighbours, so every
join is repaired: the end of one chunk and the start of the next are encoded anew,
from the last place in the first chunk to the first place in the second at which
both encodings must agree. Such a place is a white space after a character that is
none: there the pre-tokenizer always splits, whatever follows or precedes. A chunk
without such a place is taken into the repair as a whole, until there is agreement.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.arrow import in_batches, map_rows, slices
from starloom.llm.bounded import most_frequent

#: A cut where so many low bits of the rolling hash are zero: chunks of about 512 bytes.
CUT_BITS = 9
LEAST_CHUNK = 64
#: Digests of shared chunks that go to the workers: at most 8 MB.
SHARED_DIGESTS = 1_000_000
#: Bytes of encoded shared chunks, and number of pieces, that a worker keeps.
CHUNK_CACHE_BYTES = 48 << 20
PIECE_CACHE = 250_000
LONGEST_KEPT = 64

# White space of the pre-tokenizer's pattern beyond ASCII, with the
# characters whose class differs between versions of Unicode.
_OTHER_SPACE = (
    "\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u2060\\u3000\\ufeff"
)
_DOUBTFUL = re.compile(f"[{_OTHER_SPACE}]")
_PIECES = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
_SPLIT = re.compile(rf"(?<=[^\t-\r {_OTHER_SPACE}])(?=[ \n])")

_GEAR = np.random.default_rng(20_240_310).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def cuts(data: bytes) -> list[int]:
    """Where a text is cut, its start and end included; never inside a character."""
    n = len(data)
    if n < 2 * LEAST_CHUNK:
        return [0, n]
    raw = np.frombuffer(data, np.uint8)
    h = _GEAR[raw]
    for step in (1, 2, 4, 8, 16):  # the sum over the last 32 bytes, each shifted by its age
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    found = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    out = [0]
    for at in found.tolist():
        while at < n and data[at] & 0xC0 == 0x80:
            at += 1
        if at - out[-1] >= LEAST_CHUNK and n - at >= LEAST_CHUNK:
            out.append(at)
    out.append(n)
    return out


def digest(chunk: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(chunk, digest_size=8).digest(), "little", signed=True)


def pieces(text: str) -> list[str]:
    """The text cut at every place where the pre-tokenizer must split."""
    return _PIECES.findall(text) if not _DOUBTFUL.search(text) else _SPLIT.split(text)


class _Pieces(dict):
    """Packed ids by piece, in two generations."""

    def __init__(self, tokenizer: Tokenizer, entries: int):
        super().__init__()
        self.encode, self.old, self.half = tokenizer.encode, {}, max(1, entries // 2)

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            ids = self.encode(piece, add_special_tokens=False).ids
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class ChunkEncoder:
    """Encodes texts; keeps chunks whose digests are in ``shared`` (sorted)."""

    def __init__(self, path: str, shared: np.ndarray, chunk_bytes: int = CHUNK_CACHE_BYTES, piece_entries: int = PIECE_CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.look = _Pieces(tokenizer, piece_entries).__getitem__
        self.shared, self.kept, self.room, self.most = shared, {}, chunk_bytes, chunk_bytes

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.look, pieces(text)))

    def parts(self, text: str) -> tuple[str, bytes, str] | None:
        """Unsafe start, ids between, unsafe end; None if no two places agree."""
        found = pieces(text)
        if len(found) < 2:
            return None
        return found[0], b"".join(map(self.look, found[1:-1])), found[-1]

    def chunk(self, data: bytes, key: int) -> tuple[str, bytes, str] | None:
        known = self.kept.get(key)
        if known is not None and known[0] == data:
            return known[1]
        made = self.parts(data.decode())
        cost = 200 + 2 * len(data) + (len(made[1]) if made else 0)
        if cost > self.room:
            self.kept, self.room = {}, self.most
        if known is None and cost <= self.room:
            self.kept[key] = (data, made)
            self.room -= cost
        return made

    def runs(self, data: bytes) -> list[tuple[int, int, int | None]]:
        """Shared chunks with their digests; what lies between them as one run."""
        at = cuts(data)
        if not len(self.shared):
            return [(0, len(data), None)]
        keys = np.array([digest(data[a:b]) for a, b in zip(at, at[1:])], np.int64)
        place = np.minimum(np.searchsorted(self.shared, keys), len(self.shared) - 1)
        is_shared = (self.shared[place] == keys).tolist()
        out: list[tuple[int, int, int | None]] = []
        for a, b, key, known in zip(at, at[1:], keys.tolist(), is_shared):
            if known:
                out.append((a, b, key))
            elif out and out[-1][2] is None:
                out[-1] = (out[-1][0], b, None)
            else:
                out.append((a, b, None))
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        data = text.encode()
        runs = self.runs(data)
        if len(runs) == 1 and runs[0][2] is None:
            return self.plain(text)
        out, open_end = [], ""
        for a, b, key in runs:
            made = self.parts(data[a:b].decode()) if key is None else self.chunk(data[a:b], key)
            if made is None:  # nowhere to agree yet: the whole chunk belongs to the repair
                open_end += data[a:b].decode()
                continue
            start, ids, end = made
            out += (self.plain(open_end + start), ids)
            open_end = end
        out.append(self.plain(open_end))
        return b"".join(out)


def token_bytes(path: str) -> list[bytes]:
    """What each id stands for. The file writes a byte as a character: printable
    ones as themselves, the others in order from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    of = {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
    tokenizer = Tokenizer.from_file(path)
    special = tokenizer.get_added_tokens_decoder()
    out = []
    for i in range(tokenizer.get_vocab_size(with_added_tokens=True)):
        token = tokenizer.id_to_token(i) or ""
        plain = i in special or not all(c in of for c in token)
        out.append(token.encode() if plain else bytes(of[c] for c in token))
    return out


def shared_chunks(docs: DataFrame, text: str = "text", most: int = SHARED_DIGESTS) -> np.ndarray:
    """Digests of chunks that occur twice or more, over whole texts of all rows,
    sorted. If there are over ``most``, those of higher counts, by doubling the
    least: others are encoded wherever they occur, with the same result."""

    def run(batches):
        for part in slices(batches):
            seen: dict[int, int] = {}
            for data in part.column(0).to_pylist():
                if data:
                    at = cuts(data)
                    for a, b in zip(at, at[1:]):
                        key = digest(data[a:b])
                        seen[key] = seen.get(key, 0) + 1
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(seen), pa.int64()), "n": pa.array(list(seen.values()), pa.int64())})

    counted = in_batches(docs.select(F.col(text).cast("binary")), run, "chunk bigint, n bigint")
    return np.sort(most_frequent(counted, "chunk", 1, most).toPandas()["chunk"].to_numpy(np.int64))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``key``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers)
    of each row, and with ``decoded`` the text that the ids give back.

    Null and empty texts have no ids; a null key stays null; repeated rows each
    give a row; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, text))
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def setup():
        encoder, table = ChunkEncoder(path, shared.value), token_bytes(path)

        def each(k, t):
            ids = encoder.encode(t or "")
            row = (k, len(ids) // 4, ids)
            return (*row, decode_ids(ids, table)) if decoded else row

        return each

    ddl = f"key {narrow.schema['key'].dataType.simpleString()}, n_tokens bigint, ids binary"
    out = map_rows(narrow, setup, ddl + ", decoded string" * decoded)
    return out.withColumnRenamed("key", key)


def decode_ids(ids: bytes, table: list[bytes]) -> str:
    return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``text`` of each row of ids; null ids give an empty text."""
    narrow = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))

    def setup():
        table = token_bytes(path)
        return lambda k, packed: (k, decode_ids(packed or b"", table))

    ddl = f"key {narrow.schema['key'].dataType.simpleString()}, text string"
    return map_rows(narrow, setup, ddl).withColumnRenamed("key", key)

