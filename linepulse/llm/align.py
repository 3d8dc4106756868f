"""Alignment of two tokenizers' tokens by a galloping intersection of their ends.

Both tokenizations of a text cover the same bytes, so each is the ascending
list of the places where its tokens end.  The shorter list drives: each of its
ends is sought in the longer one from where the last was found, by steps that
double and a binary search within the last step.  Ends found are common and cut
the tokens into groups; the ranks of successive ends give the range of longer
tokens that a shorter list's token overlaps.

Tokens that end together are a suffix of one another, so the pairs of ids that
can ever be linked are known from the two vocabularies alone.  Counts over the
corpus are vectors over these pairs, whatever the number of documents.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import map_slices, stage, table, texts_of

CACHED_CHUNKS = 350_000     # chunks whose ids a worker remembers
CACHED_CHARS = 40
RUN_TOKENS = 1 << 18        # tokens of several texts that are aligned at once
_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")


def _byte_values() -> dict[str, int]:
    """The bytes that byte-level vocabularies write as these characters: bytes
    printable in Latin-1 as themselves, the others as the next ones from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(others)}}


class Vocabularies:
    """The two tokenizers: A byte-level (a tokenizers file), B of pieces with
    byte fallback (a sentencepiece file), and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True      # their strings in a text are text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        values, special = _byte_values(), self.a.get_added_tokens_decoder()
        self.bytes_a: list[bytes] = []
        for i in range(self.a.get_vocab_size()):
            token = self.a.id_to_token(i) or ""
            self.bytes_a.append(token.encode() if i in special else bytes(values[c] for c in token))
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size())]
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # A chunk is encoded alone only if no piece of B goes on over a space.
        self.splits = not any(" " in x.lstrip(b" ").decode("utf-8", "ignore") for x in self.bytes_b)
        self.known_a: dict[str, bytes] = {}
        self.known_b: dict[str, bytes] = {}
        self.odd: set[str] = set()              # known chunks whose tokens give other bytes

    def _ids_of(self, chunks: list[str], apart: bool) -> tuple[list[bytes], list[bytes], set[str]]:
        """Ids of the chunks by A and by B, packed, and the chunks that either
        does not give back.  Unless ``apart``, the chunks are one text to A,
        whose ids are cut where the chunks end."""
        wants = [b" " + c.encode() for c in chunks]
        body = b"".join(wants)
        sizes = np.array(list(map(len, wants)), dtype=np.int64)

        def packed(flat: np.ndarray, counts: np.ndarray) -> list[bytes]:
            ids, cuts = flat.tobytes(), [0, *(4 * np.cumsum(counts)).tolist()]
            return [ids[x:y] for x, y in zip(cuts, cuts[1:])]

        ids_b = self.b.encode(chunks, num_threads=1)
        count_b = np.array(list(map(len, ids_b)), dtype=np.int64)
        flat_b = np.fromiter(chain.from_iterable(ids_b), np.uint32, int(count_b.sum()))
        ends_b = np.concatenate([[0], np.cumsum(self.length_b[flat_b])])[np.cumsum(count_b)]
        odd = set()
        if (np.any(np.diff(ends_b, prepend=0) != sizes)
                or b"".join(map(self.bytes_b.__getitem__, flat_b.tolist())) != body):
            odd = {c for c, w, y in zip(chunks, wants, ids_b) if b"".join(map(self.bytes_b.__getitem__, y)) != w}
        if not apart:
            ids = self.a.encode_batch_fast([" " + " ".join(chunks)], add_special_tokens=False)[0].ids
            flat = np.array(ids, dtype=np.uint32)
            stops = np.searchsorted(np.cumsum(self.length_a[flat]), np.cumsum(sizes)) + 1
            if b"".join(map(self.bytes_a.__getitem__, ids)) == body and stops[-1] == len(flat):
                return packed(flat, np.diff(stops, prepend=0)), packed(flat_b, count_b), odd
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        odd.update(c for c, w, x in zip(chunks, wants, ids_a) if b"".join(map(self.bytes_a.__getitem__, x)) != w)
        return [array("I", x).tobytes() for x in ids_a], packed(flat_b, count_b), odd

    def _learn(self, chunks: list[str], apart: bool, a: dict[str, bytes], b: dict[str, bytes],
               odd: set[str]) -> None:
        if chunks:
            packed_a, packed_b, found = self._ids_of(chunks, apart)
            a.update(zip(chunks, packed_a))
            b.update(zip(chunks, packed_b))
            odd.update(found)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of " " + text by A and of text by B; none where a tokenizer's
        tokens do not give the bytes of " " + text, or the text is empty.

        Neither tokenizer joins what is on either side of a single space between
        two non-spaces, so a text's ids are those of its chunks, each with the
        space before it, and the ids of short chunks are remembered."""
        if len(self.known_a) > CACHED_CHUNKS:
            for known in (self.known_a, self.known_b, self.odd):
                known.clear()
        split, need = [], set()
        for text in texts:
            parts = text.split(" ") if self.splits else [text]
            new = set(parts).difference(self.known_a)
            if self.splits and any(not p or p[0].isspace() or p[-1].isspace() for p in new):
                parts = _BETWEEN_WORDS.split(text)
                new = set(parts).difference(self.known_a)
            split.append(parts)
            need.update(new)
        need.discard("")
        kept = [p for p in need if len(p) <= CACHED_CHARS and not p[0].isspace() and not p[-1].isspace()]
        self._learn(kept, False, self.known_a, self.known_b, self.odd)
        once_a: dict[str, bytes] = {}
        once_b: dict[str, bytes] = {}
        odd: set[str] = set()
        self._learn(list(need.difference(kept)), True, once_a, once_b, odd)
        out = []
        for text, parts in zip(texts, split):
            if not text or not odd.isdisjoint(parts) or not self.odd.isdisjoint(parts):
                out.append((_NONE, _NONE))
                continue
            try:
                a = b"".join(map(self.known_a.__getitem__, parts))
                b = b"".join(map(self.known_b.__getitem__, parts))
            except KeyError:
                a = b"".join(self.known_a.get(p) or once_a[p] for p in parts)
                b = b"".join(self.known_b.get(p) or once_b[p] for p in parts)
            out.append((np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)))
        return out


_NONE = np.zeros(0, dtype=np.int64)


@cache      # by worker process, kept over its tasks
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


class Pairs:
    """Numbers for the pairs of tokens of which one's bytes end the other's: the
    longer token's first number and the shorter one's length, for ids of equal
    bytes also which of them it is.  ``size`` numbers, whatever the corpus."""

    def __init__(self, bytes_a: Sequence[bytes], bytes_b: Sequence[bytes]):
        def among_equals(tokens: Sequence[bytes]) -> np.ndarray:
            seen: dict[bytes, int] = {}
            out = np.zeros(len(tokens), dtype=np.int64)
            for k, x in enumerate(tokens):
                out[k] = seen.get(x, 0)
                seen[x] = out[k] + 1
            return out

        self.bytes_a, self.bytes_b = bytes_a, bytes_b
        self.length_a = np.array(list(map(len, bytes_a)), dtype=np.int64)
        self.length_b = np.array(list(map(len, bytes_b)), dtype=np.int64)
        self.equal_a, self.equal_b = among_equals(bytes_a), among_equals(bytes_b)
        self.each_a, self.each_b = int(self.equal_a.max()) + 1, int(self.equal_b.max()) + 1
        ends = np.cumsum(np.concatenate([self.length_a * self.each_b, self.length_b * self.each_a]))
        starts = np.concatenate([[0], ends[:-1]])
        self.first_a, self.first_b = starts[:len(bytes_a)], starts[len(bytes_a):]
        self.size = int(ends[-1])

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        size_a, size_b = self.length_a[a], self.length_b[b]
        return np.where(size_a >= size_b,
                        self.first_a[a] + (size_b - 1) * self.each_b + self.equal_b[b],
                        self.first_b[b] + (size_a - 1) * self.each_a + self.equal_a[a])

    def b_of(self, numbers: np.ndarray) -> np.ndarray:
        """The B id of each numbered pair."""
        ids: dict[tuple[bytes, int], int] = {
            (x, int(k)): i for i, (x, k) in enumerate(zip(self.bytes_b, self.equal_b))}
        out = np.searchsorted(self.first_b, numbers, side="right") - 1
        of_a = np.flatnonzero(numbers < self.first_b[0])
        at = np.searchsorted(self.first_a, numbers[of_a], side="right") - 1
        size, which = np.divmod(numbers[of_a] - self.first_a[at], self.each_b)
        out[of_a] = [ids[self.bytes_a[i][-n - 1:], k] for i, n, k in
                     zip(at.tolist(), size.tolist(), which.tolist())]
        return out


@cache
def vocabulary_pairs(path_a: str, path_b: str) -> Pairs:
    v = vocabularies(path_a, path_b)
    return Pairs(v.bytes_a, v.bytes_b)


STRIDE = 8      # values that start from the rank of one before


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each value of ``short`` the rank in ``long`` of the first value not
    below it (both ascending; len(long) if there is none).

    Every ``STRIDE``-th value is sought first, the same way; each of the others
    starts from the rank of the one before it, doubles its step until the value
    is passed and searches the last step by halves.  All do so at once.
    """
    n = len(long)
    if not len(short) or not n:
        return np.zeros(len(short), dtype=np.int64)
    low = np.zeros(len(short), dtype=np.int64)
    if len(short) > STRIDE:
        low = np.repeat(gallop(short[::STRIDE], long), STRIDE)[:len(short)]
    high, step = low.copy(), 1
    on = np.flatnonzero(low < n)
    while len(on):
        on = on[long[high[on]] < short[on]]
        low[on] = high[on] + 1
        high[on] += step
        step *= 2
        out = on[high[on] >= n]
        high[out] = n
        on = on[high[on] < n]
    on = np.flatnonzero(low < high)
    while len(on):
        middle = (low[on] + high[on]) >> 1
        less = long[middle] < short[on]
        low[on[less]] = middle[less] + 1
        high[on[~less]] = middle[~less]
        on = on[low[on] < high[on]]
    return low


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cut_a, cut_b, ranks): the indices of the tokens that end together, by
    galloping with the shorter list, and the ranks of its ends in the longer."""
    swap = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
    ranks = gallop(short, long)
    inside = np.flatnonzero(ranks < len(long))
    hit = inside[long[ranks[inside]] == short[inside]]
    found = ranks[hit]
    return (found, hit, ranks) if swap else (hit, found, ranks)


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A the first and the last token of B that it shares a
    byte with, from the ranks of the shorter list's ends in the longer."""
    swap = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
    if not len(short):
        return _NONE, _NONE
    # A token starts in the longer token after the one that ends where it starts.
    ends_there = long[np.minimum(ranks, len(long) - 1)] == short
    first = np.concatenate([[0], (ranks + ends_there)[:-1]]).astype(np.int64)
    last = np.minimum(ranks, len(long) - 1)
    if not swap:
        return first, last
    k = np.arange(len(long))
    return np.searchsorted(last, k, side="left"), np.searchsorted(first, k, side="right") - 1


@cache
def _written(n: int) -> np.ndarray:
    """0..n-1 in decimal digits, as the 8 bytes of a number; zero after the last."""
    return np.array([str(k) for k in range(n)], dtype="S8").view(np.dtype("<u8"))


_SEPARATOR_AT = np.uint64(8 * 7)


def group_text(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids (below 10,000,000) of the groups that end at the cuts."""
    if not len(a):
        return b""
    written = _written(1 << int(max(a.max(), b.max())).bit_length())
    each_a, each_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    place_a = np.arange(len(a)) + np.repeat(cut_b - each_b + 1, each_a)
    place_b = np.arange(len(b)) + np.repeat(cut_a + 1, each_b)
    rows = np.empty(len(a) + len(b), dtype=np.dtype("<u8"))
    rows[place_a] = written[a]
    rows[place_b] = written[b]
    after = np.full(len(rows), ord(","), dtype=np.uint64)
    after[place_a[cut_a]] = ord("|")
    after[place_b[cut_b]] = ord(";")
    flat = (rows | (after << _SEPARATOR_AT)).view(np.uint8)
    return flat[flat != 0].tobytes()[:-1]


KINDS = {"ids_a": "array<long>", "ids_b": "array<long>", "cut_a": "array<long>", "cut_b": "array<long>",
         "first_b": "array<long>", "last_b": "array<long>", "n_a": "long", "n_b": "long",
         "n_groups": "long", "groups_sha256": "string", "links": "binary"}


def align(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, text: str = "text",
          columns: Sequence[str] = tuple(KINDS)[:6]) -> DataFrame:
    """``docs`` with the alignment of both tokenizers' tokens; ``columns`` names
    what to return of

    * ids_a, ids_b: the tokens of " " + text by A, of text by B (which adds the space);
    * cut_a, cut_b: the last token of each group, which ends in both;
    * first_b, last_b: for each token of A the range of tokens of B it overlaps;
    * n_a, n_b, n_groups, groups_sha256 ("a1,a2|b1;a3|b2,b3", hashed);
    * links: the groups' last tokens as numbers of ``Pairs``, packed in 4 bytes.

    A null or empty text, or one that a tokenizer does not give back byte by
    byte, has no tokens: empty arrays, zeros and ''.  Whole texts are aligned,
    rows each for itself.  Input columns of the chosen names are replaced.
    """
    chosen = list(columns)

    def make():
        v = vocabularies(tokenizer_a, tokenizer_b)
        pairs = vocabulary_pairs(tokenizer_a, tokenizer_b)
        wants_ranges = "first_b" in chosen or "last_b" in chosen
        wants_text = "groups_sha256" in chosen

        def run(tokens: list[tuple[np.ndarray, np.ndarray]]) -> list[dict]:
            """The rows of several texts, whose lists of ends follow each other:
            both tokenizers' tokens of a text cover the same bytes."""
            a, b = (np.concatenate([t[k] for t in tokens]).astype(np.int64) for k in (0, 1))
            ends_a, ends_b = np.cumsum(v.length_a[a]), np.cumsum(v.length_b[b])
            cut_a, cut_b, ranks = common_ends(ends_a, ends_b)
            links = pairs.numbers(a[cut_a], b[cut_b]).astype(np.int32)
            stop_a, stop_b = (np.cumsum([len(t[k]) for t in tokens]) for k in (0, 1))
            stop_g = np.searchsorted(cut_a, stop_a)
            first, last = overlaps(ends_a, ends_b, ranks) if wants_ranges else (_NONE, _NONE)
            rows, i, j, g = [], 0, 0, 0
            for x, y, h in zip(stop_a.tolist(), stop_b.tolist(), stop_g.tolist()):
                own_a, own_b = cut_a[g:h] - i, cut_b[g:h] - j
                text_ = group_text(a[i:x], b[j:y], own_a, own_b) if wants_text else b""
                rows.append({"ids_a": a[i:x], "ids_b": b[j:y], "cut_a": own_a, "cut_b": own_b,
                             "first_b": first[i:x] - j, "last_b": last[i:x] - j,
                             "n_a": x - i, "n_b": y - j, "n_groups": h - g,
                             "groups_sha256": hashlib.sha256(text_).hexdigest() if text_ else "",
                             "links": links[g:h].tobytes()})
                i, j, g = x, y, h
            return rows

        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            rows, held, size = [], [], 0
            for tokens in v.encode(texts_of(part, text)):
                held.append(tokens)
                size += len(tokens[0]) + len(tokens[1])
                if size > RUN_TOKENS:
                    rows += run(held)
                    held, size = [], 0
            rows += run(held) if held else []
            kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(),
                     "array<long>": pa.list_(pa.int64())}
            return [pa.array([r[c] for r in rows], kinds[KINDS[c]]) for c in chosen]
        return fn

    return map_slices(docs, make, ", ".join(f"{c} {KINDS[c]}" for c in chosen))


def pair_counts(aligned: DataFrame, pairs: int) -> np.ndarray:
    """How many links of all rows of ``aligned`` (links) hold each of the
    ``pairs`` numbered pairs.  A task sends a row for each pair it has seen; the
    driver gets at most a number for each pair of the vocabularies."""
    def run(batches):
        counts = np.zeros(pairs, dtype=np.int64)
        for batch in batches:
            links = b"".join(batch.column(0).to_pylist())
            counts += np.bincount(np.frombuffer(links, np.int32), minlength=pairs)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["pair", "n"])

    rows = (aligned.select("links").mapInArrow(run, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))
    out = np.zeros(pairs, dtype=np.int64)
    got = rows.toPandas()
    out[got["pair"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
    return out


def best_of(pairs: Pairs, counts: np.ndarray) -> np.ndarray:
    """Whether each pair's count is the highest of the pairs of its B id."""
    seen = np.flatnonzero(counts)
    b = pairs.b_of(seen)
    most = np.zeros(len(pairs.bytes_b), dtype=np.int64)
    np.maximum.at(most, b, counts[seen])
    best = np.zeros(len(counts), dtype=bool)
    best[seen] = counts[seen] == most[b]
    return best


def link_sums(aligned: DataFrame, pairs: Pairs, counts: np.ndarray) -> DataFrame:
    """``aligned`` with n_links, n_best (links whose pair is as frequent as any
    of its B id) and count_sum (of the links' counts) for its links."""
    shared = aligned.sparkSession.sparkContext.broadcast((counts, best_of(pairs, counts)))

    def make():
        n, best = shared.value

        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            at = part.schema.names.index("links")
            links = [np.frombuffer(x, np.int32) for x in part.column(at).to_pylist()]
            return [pa.array([len(x) for x in links], pa.int64()),
                    pa.array([int(best[x].sum()) for x in links], pa.int64()),
                    pa.array([int(n[x].sum()) for x in links], pa.int64())]
        return fn

    return map_slices(aligned, make, "n_links long, n_best long, count_sum long")


def align_counts(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_a, n_b, n_groups, groups_sha256,
    n_links, n_best and count_sum, the counts taken over all of ``docs``.  Other
    cases as in ``align``; an empty table stays empty."""
    aligned = align(docs, tokenizer_a, tokenizer_b, text,
                    ("n_a", "n_b", "n_groups", "groups_sha256", "links"))
    at = [c.lower() for c in aligned.columns].index(text.lower())
    held = stage(aligned.drop(aligned.columns[at]), "aligned")
    pairs = vocabulary_pairs(tokenizer_a, tokenizer_b)
    return link_sums(held, pairs, pair_counts(held, pairs.size)).drop("links")


def op13_align(spark, sf_dir: str) -> DataFrame:
    """Both public tokenizers' tokens of every document, aligned."""
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align_counts(docs, public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
