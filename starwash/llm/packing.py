"""Best-fit packing: documents into sequences of at most ``capacity`` tokens.

Texts are tokenised whole in Arrow batches. Ids are those of the ``tokenizers``
file; where the same byte-level vocabulary is also given as tiktoken ranks,
texts of plain Latin characters are encoded with these (the same ids, several
times faster) and all others by the file itself. A document longer than the capacity
is cut into full pieces, of which the first may be shorter. Only the pieces'
places and lengths are shuffled, never texts or tokens.

Pieces are dealt at random into shards of about ``shard_pieces`` and each shard
is packed by best-fit decreasing: pieces by falling length, each into the open
bin with the least room that still holds it. A segment tree over the remaining
capacities (leaf c: the number of open bins with c tokens left) finds that bin
in log(capacity) steps. Equal pieces that find bins of equal room are placed
together. A shard wastes at most its last open bins, so with thousands of bins a
shard the number of sequences is that of one global packing but for a few per
mille, and shards are independent tasks of bounded size: no key of the data
decides a shard, so hot ids or sources cannot fill one.

Sequence ids are ``shard * 2^32 + bin``.

Defined cases: a null or empty text is the end token alone; repeated rows are
packed each on their own; null ids stay null; an empty table gives no rows;
columns of the input other than id and text are not returned.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwash.llm.common import save, small_batches

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"


class RoomTree:
    """Segment tree over remaining capacities 0..capacity: counts of open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        k = room + self.size
        while k:
            self.count[k] += n
            k >>= 1

    def tightest(self, need: int) -> int:
        """Least room >= need with an open bin, or -1."""
        k = need + self.size
        if self.count[k]:
            return need
        while k > 1 and (k & 1 or not self.count[k + 1]):  # up to where a right neighbour has bins
            k >>= 1
        if k <= 1:
            return -1
        k += 1
        while k < self.size:
            k = 2 * k if self.count[2 * k] else 2 * k + 1
        return k - self.size


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece (lengths in 1..capacity)."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree, with_room, opened = RoomTree(capacity), defaultdict(list), 0
    at = 0
    while at < len(order):
        length = int(lengths[order[at]])
        end = at
        while end < len(order) and lengths[order[end]] == length:
            end += 1
        while at < end:
            room = tree.tightest(length)
            if room < 0:  # open a bin for as many of these as it holds
                n = min(end - at, capacity // length)
                here = order[at : at + n]
                bins[here], offsets[here] = opened, np.arange(n) * length
                left = capacity - n * length
                opened, at = opened + 1, at + n
                tree.add(left, 1)
                with_room[left].append(opened - 1)
                continue
            waiting = with_room[room]
            n = min(end - at, len(waiting))
            here, taken = order[at : at + n], waiting[-n:]
            del waiting[-n:]
            bins[here], offsets[here] = taken, capacity - room
            tree.add(room, -n)
            tree.add(room - length, n)
            with_room[room - length].extend(taken)
            at += n
    return bins, offsets


def pieces_of(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece; all but the first are full."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n_tokens, capacity)]


#: characters on which all regex engines agree about letters, numbers and spaces
_PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\xa1-\\u024f]*")
#: fixed value: the pre-tokenizer's pattern of byte-level BPE
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(tokenizer_path: str, ranks_path: str | None = None):
    """A function from a list of texts to their lists of ids."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.encode_special_tokens = True  # such strings in a text are ordinary text
    exact = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    if ranks_path is None:
        return exact
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [fast.encode_ordinary(t) if _PLAIN.fullmatch(t) else exact([t])[0] for t in texts]


def tokenize_pieces(documents: DataFrame, tokenizer_path: str, ranks_path: str | None = None, capacity: int = 1024, end_id: int = 2,
                    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece; with ``keep_ids`` also its token ids."""
    small_batches(documents.sparkSession)
    schema = PIECE_SCHEMA + (", token_ids array<int>" if keep_ids else "")

    def run(batches):
        encode = encoder(tokenizer_path, ranks_path)
        for frame in batches:
            rows = []
            texts = [t if isinstance(t, str) else "" for t in frame["t"]]
            for doc, tokens in zip(frame["i"], encode(texts)):
                ids = np.array([*tokens, end_id], dtype="<u4")
                for k, (s, n) in enumerate(pieces_of(len(ids), capacity)):
                    part = ids[s : s + n]
                    rows.append((doc, k, s, n, zlib.crc32(part.tobytes()), *([part.astype(int)] if keep_ids else [])))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return documents.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).mapInPandas(run, schema)


def pack(pieces: DataFrame, capacity: int = 1024, shard_pieces: int = 16384) -> DataFrame:
    """Pieces (``PIECE_SCHEMA`` columns) with ``sequence_id`` and ``offset``."""
    pieces = save(pieces.select("doc_id", "piece", "start", "length", "ids_crc32"), "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))
    # the running row number of a written table is the same in every attempt of a task
    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        # equal pieces are interchangeable, but a fixed order makes retries give the same rows
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        bins, offsets = best_fit_decreasing(frame["length"].to_numpy(), capacity)
        return frame.assign(sequence_id=frame.pop("shard") * (1 << 32) + bins, offset=offsets)

    schema = PACKED_SCHEMA
    return pieces.withColumn("shard", shard).groupBy("shard").applyInPandas(place, schema)


def pack_documents(documents: DataFrame, tokenizer_path: str, ranks_path: str | None = None, capacity: int = 1024,
                   end_id: int = 2, shard_pieces: int = 16384, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    pieces = tokenize_pieces(documents, tokenizer_path, ranks_path, capacity, end_id, id_col, text_col)
    return pack(pieces, capacity, shard_pieces)
