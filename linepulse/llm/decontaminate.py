"""Benchmark decontamination by a prefix-filtered containment join.

An item is cut into windows of ``window`` words; a window is the ordered set
of its word shingles.  Containment must be whole, so one shingle of a window
is a necessary prefix: the rarest in the corpus.  Where a document holds that
shingle, the place fixes where the window would start; windows that would
start before or end after the document fall to the positional and length
bounds, and the rest are compared word for word.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import map_slices, numbered, stage, table, texts_of

WINDOW = 13
SHINGLE = 5
BLOCK_BYTES = 8 << 20        # text of items broadcast at once; more items go in blocks

# Word bytes: digits, a-z after lower-casing A-Z, and everything beyond ASCII.
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


def windows_of(words: list[bytes], window: int = WINDOW) -> list[tuple[bytes, ...]]:
    """All runs of ``window`` words; fewer words, but not none, are one run."""
    if not words:
        return []
    width = min(window, len(words))
    return list(dict.fromkeys(tuple(words[i:i + width]) for i in range(len(words) - width + 1)))


class Prefixes:
    """Windows under their necessary shingle: shingle -> [(place in the
    window, window, numbers of the items that have it)]."""

    def __init__(self, items: list[str | None], window: int, shingle: int,
                 counts: dict[bytes, int]):
        owners: dict[tuple[bytes, ...], list[int]] = {}
        for k, text in enumerate(items):
            for w in windows_of(words_of(text), window):
                owners.setdefault(w, []).append(k)
        self.by_shingle: dict[tuple[bytes, ...], list] = {}
        for w, ks in owners.items():
            width = min(shingle, len(w))
            order = [(counts.get(b" ".join(w[p:p + width]), 0), w[p:p + width], p)
                     for p in range(len(w) - width + 1)]
            _, rarest, place = min(order)
            self.by_shingle.setdefault(rarest, []).append((place, w, ks))
        self.widths = sorted({len(s) for s in self.by_shingle})
        self.firsts = {s[0] for s in self.by_shingle}

    def find(self, words: list[bytes]) -> list[tuple[int, int, list[int]]]:
        """(start, length, items) of every window that occurs in ``words``."""
        hits, n, firsts = [], len(words), self.firsts
        for i in [i for i, w in enumerate(words) if w in firsts]:
            for width in self.widths:
                for place, w, ks in self.by_shingle.get(tuple(words[i:i + width]), ()):
                    start = i - place
                    if start >= 0 and start + len(w) <= n and tuple(words[start:start + len(w)]) == w:
                        hits.append((start, len(w), ks))
        return hits


def _shingles(items: list[str | None], window: int, shingle: int) -> set[tuple[bytes, ...]]:
    found = set()
    for text in items:
        words = words_of(text)
        width = min(shingle, len(words), window)
        found.update(tuple(words[i:i + width]) for i in range(len(words) - width + 1) if width)
    return found


def corpus_counts(docs: DataFrame, items: list[str | None], text: str = "text",
                  window: int = WINDOW, shingle: int = SHINGLE) -> dict[bytes, int]:
    """How often each shingle of the items occurs over all documents."""
    wanted = _shingles(items, window, shingle)
    firsts, widths = {s[0] for s in wanted if s}, sorted({len(s) for s in wanted if s})

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                words = words_of(t)
                for i in [i for i, w in enumerate(words) if w in firsts]:
                    for width in widths:
                        s = tuple(words[i:i + width])
                        if s in wanted:
                            counts[s] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([b" ".join(s) for s in counts], pa.binary()),
             pa.array(list(counts.values()), pa.int64())], names=["shingle", "n"])

    rows = (docs.select(F.col(f"`{text}`").alias("text"))
            .mapInArrow(run, "shingle binary, n long")
            .groupBy("shingle").agg(F.sum("n").alias("n")).collect())
    return {bytes(r["shingle"]): r["n"] for r in rows}


def item_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_bytes`` of text (a longer item
    goes alone or with few), each fetched when it is asked for: the driver
    holds one block at a time."""
    size = F.coalesce(F.octet_length(F.col("text")), F.lit(0)) + 32
    held = stage(items.select(F.col(f"`{item_id}`").cast("string").alias("id"),
                              F.col(f"`{text}`").alias("text")).withColumn("size", size), "items")
    total = held.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for b in range(blocks):
        yield [(r["id"], r["text"]) for r in
               held.filter(part == b).orderBy("id", "text").select("id", "text").collect()]


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE, share: int = 20,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, item_ids (sorted as strings) and
    contaminated.

    A document's word is hit if a window of an item covers it; a document is
    contaminated if n_hit > 0 and share * n_hit >= n_words.  Null, empty or
    wordless texts have no words and no hits; so have items without words.
    Items of the same id count once, an item without an id hits but is not
    listed.  Repeated rows are judged alike.  Input columns of these names
    are replaced.  Items go to the tasks in blocks of at most ``block_bytes``
    of text; the hits of a row are carried from block to block.
    """
    out = without_hits(docs)
    for n, block in enumerate(item_blocks(items, item_id, item_text, block_bytes)):
        ids = [i for i, _ in block]
        texts = [t for _, t in block]
        counts = corpus_counts(docs, texts, text, window, shingle)
        out = _find(out, Prefixes(texts, window, shingle, counts), ids, text, first=n == 0)
    return _judge(out, share)


def without_hits(docs: DataFrame) -> DataFrame:
    names = {"n_words", "n_hit", "n_items", "item_ids", "contaminated", "_spans", "_items"}
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])


def _merge(spans: list[tuple[int, int]]) -> list[int]:
    """Starts and ends of the union of the spans, in one flat list."""
    flat: list[int] = []
    for lo, hi in sorted(spans):
        if flat and lo <= flat[-1]:
            flat[-1] = max(flat[-1], hi)
        else:
            flat += [lo, hi]
    return flat


def _find(docs: DataFrame, prefixes: Prefixes, ids: list, text: str, first: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((prefixes, ids))

    def make():
        found, names = shared.value

        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            before = [None, None] if first else [part.column(part.schema.names.index(c)).to_pylist()
                                                 for c in ("_spans", "_items")]
            n_words, spans, items = [], [], []
            for k, t in enumerate(texts_of(part, text)):
                words = words_of(t)
                hits = found.find(words)
                own = [(a, a + w) for a, w, _ in hits]
                listed = {names[i] for _, _, ks in hits for i in ks if names[i] is not None}
                if not first:
                    old = before[0][k]
                    own += list(zip(old[::2], old[1::2]))
                    listed.update(before[1][k])
                n_words.append(len(words))
                spans.append(_merge(own))
                items.append(sorted(listed))
            return [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                    pa.array(items, pa.list_(pa.string()))]
        return fn

    return map_slices(docs, make, "n_words long, _spans array<long>, _items array<string>")


def _judge(docs: DataFrame, share: int) -> DataFrame:
    covered = F.aggregate(F.transform("_spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    return (docs.withColumn("n_hit", covered)
            .withColumn("n_items", F.size("_items").cast("long"))
            .withColumnRenamed("_items", "item_ids")
            .withColumn("contaminated", (F.col("n_hit") > 0)
                        & (F.col("n_hit") * share >= F.col("n_words"))).drop("_spans"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows; columns stay as they are."""
    plain, text = numbered(docs, "text")
    judged = decontaminate(plain, items, text)
    return judged.filter(~F.col("contaminated")).select(*plain.columns).toDF(*docs.columns)


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Hits of the benchmark's 13-word windows in every document."""
    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                          table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
                        "contaminated")


def op8_oracle_sql() -> str:
    """The same in SQL: positions of every window in every document."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = (r"regexp_extract_all(translate(coalesce(text, ''), '%s', '%s'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')" % (upper, lower))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {words} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS width,
               array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS body
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i
              FROM b WHERE len(w) > 0)),
widths AS (SELECT DISTINCT width FROM win),
place AS (SELECT rid, w, width, unnest(range(1, len(w) - width + 2)) AS i
          FROM d, widths WHERE len(w) >= width),
hit AS (SELECT DISTINCT rid, i, p.width, item_id FROM place p
        JOIN win ON win.width = p.width
                AND win.body = array_to_string(p.w[i:i + p.width - 1], ' ')),
covered AS (SELECT rid, count(DISTINCT pos) AS n_hit
            FROM (SELECT rid, unnest(range(i, i + width)) AS pos FROM hit) GROUP BY rid),
listed AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
           FROM (SELECT DISTINCT rid, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN listed USING (rid)"""
