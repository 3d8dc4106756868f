"""Best-fit packing of token pieces with a swap-based local search.

Pieces of one length are interchangeable, so the plan is made on the counts
by length, at most ``capacity`` numbers whatever the input: bins are patterns
(lengths of their pieces) with multiplicities.  Best-fit decreasing gives the
first patterns; then pairs of underfull patterns exchange one piece for one,
two for one or move a piece so that the sum of squared fills grows, until bins
run empty.  The plan then meets the pieces by their rank within a length.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linepulse.llm.common import map_slices, stage, table, texts_of

CAPACITY = 2048
END_ID = 0
CACHED_CHUNKS = 400_000     # chunks whose ids a worker remembers
CACHED_CHARS = 40
SEARCH_PAIRS = 200_000      # pattern pairs that the local search looks at, at most

_LETTERS = re.compile(r"[^\W\d_]+")
_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")


def _byte_characters() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes as: themselves
    where they are printable in Latin-1, else the next ones from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(others)}}


class ChunkEncoder:
    """Ids of whole texts by the tokenizer, chunk by chunk.

    The tokenizer's own first split never crosses a single space between two
    non-spaces, so a text's ids are those of its chunks in order, a chunk being
    a run up to the next such space, with the space before it.  Nor does it join
    a chunk's leading letters to what follows, so those go to the vocabulary's
    model directly.  Ids of short chunks are remembered.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}       # chunks, without their leading space
        self.tails: dict[str, bytes] = {}       # what follows a chunk's letters
        self.characters = _byte_characters()

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [_packed(e.ids) for e in found]

    def _letters(self, word: str) -> bytes:
        space = self.characters[32]
        written = (space + word if word.isascii() else
                   space + word.encode("utf-8").decode("latin-1").translate(self.characters))
        return _packed([t.id for t in self.model.tokenize(written)])

    def _chunk(self, chunk: str) -> bytes:
        head = _LETTERS.match(chunk)
        if not head or not head.group().isalpha():
            return self._encode([" " + chunk])[0]
        word, tail = head.group(), chunk[head.end():]
        ids = self.known.get(word)
        if ids is None:
            ids = self._letters(word)
            if len(word) <= CACHED_CHARS:
                self.known[word] = ids
        if not tail:
            return ids
        if tail not in self.tails:
            if len(self.tails) > CACHED_CHUNKS // 10:
                self.tails.clear()
            self.tails[tail] = self._encode([tail])[0]
        return ids + self.tails[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        known = self.known
        if len(known) > CACHED_CHUNKS:
            known.clear()
        split, need = [], set()
        for text in texts:
            parts = text.split(" ")
            new = set(parts).difference(known)
            # A part that is empty or has space at an end is no chunk of its own;
            # such parts are never among the known ones.
            if "" in new or any([p.strip() != p for p in new]):
                parts = _BETWEEN_WORDS.split(text)
                new = set(parts[1:]).difference(known)
            split.append(parts)
            need.update(new)
        heads = self._encode([parts[0] for parts in split])
        once: dict[str, bytes] = {}
        for p in need:
            if p.isalpha():
                if p not in known:
                    (known if len(p) <= CACHED_CHARS else once)[p] = self._letters(p)
            elif p:
                kept = len(p) <= CACHED_CHARS and not p[0].isspace() and not p[-1].isspace()
                (known if kept else once)[p] = self._chunk(p)
        out = []
        for head, parts in zip(heads, split):
            del parts[0]
            try:
                out.append(head + b"".join(map(known.__getitem__, parts)))
            except KeyError:
                out.append(head + b"".join(known.get(p) or once[p] for p in parts))
        return out


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


_encoders: dict[str, ChunkEncoder] = {}     # by worker process, kept over its tasks


def encoder(path: str) -> ChunkEncoder:
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of n ids: whole pieces, the rest first."""
    rest = n % capacity
    return [rest] * (rest > 0) + [capacity] * (n // capacity)


def token_pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the pieces of every
    document, its ids ending with END_ID.  Only documents beyond ``capacity``
    are cut.  A null text is empty: one piece of the END_ID alone.
    ``keep_ids`` adds the ids as little-endian unsigned 32-bit integers."""
    def make():
        enc = encoder(tokenizer)

        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            rows = []
            for ids in enc.encode(texts_of(part)):
                ids += END_ID.to_bytes(4, "little")
                start, pieces = 0, []
                for k, size in enumerate(cut(len(ids) // 4, capacity)):
                    body = ids[4 * start:4 * (start + size)]
                    pieces.append({"piece": k, "start": start, "length": size,
                                   "ids_crc32": zlib.crc32(body), **({"ids": body} if keep_ids else {})})
                    start += size
                rows.append(pieces)
            kind = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64())] + ([("ids", pa.binary())] if keep_ids else [])
            return [pa.array(rows, pa.list_(pa.struct(kind)))]
        return fn

    fields = "piece:int,start:long,length:long,ids_crc32:long" + (",ids:binary" if keep_ids else "")
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return (map_slices(texts, make, f"pieces array<struct<{fields}>>")
            .select("doc_id", F.explode("pieces").alias("p")).select("doc_id", "p.*"))


Pattern = tuple[int, ...]       # lengths in a bin, greatest first


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: by the sum, and by the pieces that exclude
    each other, over all splits of the lengths."""
    total = -(-sum(s * c for s, c in counts.items()) // capacity)
    for alpha in sorted({s for s in counts if 2 * s <= capacity} | {1}):
        alone = sum(c for s, c in counts.items() if s > capacity - alpha)
        half = {s: c for s, c in counts.items() if 2 * s > capacity and s <= capacity - alpha}
        small = sum(s * c for s, c in counts.items() if alpha <= s and 2 * s <= capacity)
        free = sum((capacity - s) * c for s, c in half.items())
        total = max(total, alone + sum(half.values()) + max(0, -(-(small - free) // capacity)))
    return total


def best_fit(counts: dict[int, int], capacity: int) -> Counter:
    """Best-fit decreasing over counts by length: patterns and their numbers of
    bins, the same as placing the pieces one after the other."""
    open_bins: dict[int, Counter] = {}      # free room -> patterns
    rooms: list[int] = []
    done: Counter = Counter()

    def put(pattern: Pattern, room: int, bins: int) -> None:
        if room == 0:
            done[pattern] += bins
        else:
            if room not in open_bins:
                open_bins[room] = Counter()
                insort(rooms, room)
            open_bins[room][pattern] += bins

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                room, pattern, bins = capacity, (), -(-left // (capacity // size))
            else:
                room = rooms[at]
                pattern, bins = min(open_bins[room].items())
                del open_bins[room][pattern]
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
            each = room // size
            full = min(bins, left // each)
            if full:
                put(pattern + (size,) * each, room - size * each, full)
                left -= full * each
                bins -= full
            if bins and left:
                put(pattern + (size,) * left, room - size * left, 1)
                left, bins = 0, bins - 1
            if bins and pattern:
                put(pattern, room, bins)
    for room in rooms:
        done.update(open_bins[room])
    return done


def _exchange(a: Pattern, b: Pattern, room: int) -> tuple[Pattern, Pattern] | None:
    """The exchange that moves most from bin b to the fuller bin a within its
    room: a piece, one piece for one, two for one or one for two."""
    gain, give, take = 0, (), ()            # give: out of a; take: out of b
    mine, theirs = sorted(set(a)), sorted(set(b))
    pairs_a = sorted({(x + y, x, y) for i, x in enumerate(a) for y in a[i + 1:]}) if len(a) < 24 else []
    sums_a = [p[0] for p in pairs_a]

    def consider(size: int, out: tuple[int, ...]) -> None:
        nonlocal gain, give, take
        if gain < size <= room:
            gain, give, take = size, (), out
        k = bisect_left(mine, size - room)
        if k < len(mine) and size - mine[k] > gain:
            gain, give, take = size - mine[k], (mine[k],), out
        if len(out) == 1:
            k = bisect_left(sums_a, size - room)
            if k < len(sums_a) and size - sums_a[k] > gain:
                gain, give, take = size - sums_a[k], pairs_a[k][1:], out

    for y in theirs:
        consider(y, (y,))
    if len(b) < 24:
        for i, x in enumerate(b):
            for y in b[i + 1:]:
                consider(x + y, (x, y))
    if not gain:
        return None
    new_a, new_b = Counter(a), Counter(b)
    for side, out, into in ((new_a, give, new_b), (new_b, take, new_a)):
        side.subtract(out)
        into.update(out)
    return (tuple(sorted(new_a.elements(), reverse=True)),
            tuple(sorted(new_b.elements(), reverse=True)))


def improve(bins: Counter, capacity: int, floor: int, pairs: int = SEARCH_PAIRS) -> Counter:
    """Local search over underfull patterns: exchanges from the least full bins
    into fuller ones, on as many bins of both patterns as there are, until no
    exchange raises the sum of squared fills, the bins reach ``floor`` or
    ``pairs`` pattern pairs have been tried."""
    bins = Counter(bins)
    stuck: set[Pattern] = set()
    while pairs > 0 and sum(bins.values()) > floor:
        under = sorted((p for p in bins if sum(p) < capacity), key=lambda p: (sum(p), p))
        moved = False
        for b in under:
            if b in stuck:
                continue
            for a in reversed(under):
                if sum(a) < sum(b) or (a == b and bins[b] < 2):
                    continue
                pairs -= 1
                found = _exchange(a, b, capacity - sum(a))
                if found:
                    n = bins[b] // 2 if a == b else min(bins[a], bins[b])
                    bins.subtract({a: n, b: n} if a != b else {a: 2 * n})
                    bins.update({p: n * found.count(p) for p in set(found) if p})
                    bins = +bins
                    stuck.discard(found[0])
                    moved = True
                    break
                if pairs <= 0:
                    break
            if moved or pairs <= 0:
                break
            stuck.add(b)
        if not moved:
            break
    return bins


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> Counter:
    """Patterns and numbers of bins that hold exactly the counted pieces."""
    if not counts:
        return Counter()
    return improve(best_fit(counts, capacity), capacity, lower_bound(counts, capacity))


def places(plan: Counter) -> dict[str, np.ndarray]:
    """The plan by length and rank: for each run of ranks of a length its
    first rank, the copies in a bin, the first bin and the first offset."""
    next_rank: Counter = Counter()
    rows, bin_at = [], 0
    for pattern in sorted(plan, reverse=True):
        offset = 0
        for size, copies in sorted(Counter(pattern).items(), reverse=True):
            rows.append((size, next_rank[size], copies, bin_at, offset))
            next_rank[size] += copies * plan[pattern]
            offset += size * copies
        bin_at += plan[pattern]
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "copies", "bin", "offset"), cols))


RANK_BITS = 48


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, with length 1..capacity) with sequence_id and
    offset; the pieces of a sequence are gapless from 0.

    An empty table stays empty.  Equal pieces and repeated rows are packed each
    for itself.  Columns named sequence_id or offset are replaced.
    Rows are ranked within a length by the part file they were staged in and
    their place there, so that a length shared by many rows is spread over as
    many groups as there are parts.
    """
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset", "_row", "_part")]
    held = stage(pieces.select(*[F.col(f"`{c}`") for c in kept])
                 .withColumn("_row", F.monotonically_increasing_id()), "pieces")
    held = held.withColumn("_part", F.shiftright("_row", 33))
    parts = stage(held.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n")), "part_counts")
    counts = {int(r["length"]): int(r["n"]) for r in
              parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"piece lengths must lie in 1..{capacity}")
    plan = places(plan_bins(counts, capacity))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0))
                           .alias("_before"))
    local = F.row_number().over(Window.partitionBy("length", "_part").orderBy("_row")) - 1
    ranked = (held.withColumn("_local", local).join(offsets, ["length", "_part"])
              .withColumn("_rank", F.col("_before") + F.col("_local"))
              .select(*[F.col(f"`{c}`") for c in kept], "_rank"))
    shared = pieces.sparkSession.sparkContext.broadcast(plan)

    def make():
        p = shared.value
        key = (p["length"] << RANK_BITS) + p["rank"]

        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            names = [n.lower() for n in part.schema.names]
            size = part.column(names.index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = part.column(names.index("_rank")).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(key, (size << RANK_BITS) + rank, side="right") - 1
            k = rank - p["rank"][at]
            return [pa.array(p["bin"][at] + k // p["copies"][at]),
                    pa.array(p["offset"][at] + k % p["copies"][at] * size)]
        return fn

    return map_slices(ranked, make, "sequence_id long, offset long").drop("_rank")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                   keep_ids: bool = False) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) with their places; ``tokenizer`` is
    the path of a vocabulary file, byte_bpe_50k.json by default."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack(token_pieces(docs, tokenizer, capacity=capacity, keep_ids=keep_ids), capacity)


def op7_packing(spark, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
