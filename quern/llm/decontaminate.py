"""Benchmark decontamination: documents that hold a test item with few edits.

An item of m characters may differ by ``k = floor(m * error_rate)`` edits (insertions, deletions,
replacements).  It is split into k + 1 pieces; k edits leave one of them at least untouched, so every
occurrence holds an exact piece at a known offset, up to k places off.  One automaton finds all
pieces in one pass over a document; around each hit, Myers' bit-parallel algorithm gives the least
edit distance of the item to any stretch of the window.

Texts are compared with letters lower-cased and white space runs as one space.  Short items, of which
a few edits would make another text, are looked for as they are, between characters that are neither
letters nor digits.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import fresh, release, small_batches, stage

#: Bytes of test items that go to the executors at once (a worker needs about 70 times as much for the
#: automaton); more items are done block by block.
BLOCK_BYTES = 4_000_000


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def pieces_of(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of k + 1 pieces of nearly equal length."""
    n = min(k + 1, len(item))
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def budget(item: str, error_rate: float) -> int:
    return int(len(item) * error_rate)


def masks_of(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def least_distance(masks: dict[str, int], m: int, window: str) -> tuple[int, int]:
    """Least edit distance of the item to a stretch of ``window``, and where that stretch ends."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, d = full, 0, m
    best, at = m, 0
    for i, c in enumerate(window, 1):
        eq = masks.get(c, 0)
        x = eq | down
        h = (((eq & up) + up) ^ up) | eq
        right_up = down | (full & ~(h | up))
        right_down = up & h
        if right_up & top:
            d += 1
        elif right_down & top:
            d -= 1
        right_up = right_up << 1 & full
        right_down = right_down << 1 & full
        up = right_down | (full & ~(x | right_up))
        down = right_up & x
        if d < best:
            best, at = d, i
    return best, at


def start_of(item: str, text: str, end: int, distance: int) -> int:
    """Start of the stretch of ``text`` up to ``end`` that is ``distance`` edits from the item; of
    several the one whose length is nearest to the item's, the longer of two."""
    m = len(item)
    back, masks = text[max(0, end - m - distance) : end][::-1], masks_of(item[::-1])
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, d = full, 0, m
    options = [0] if d == distance else []
    for i, c in enumerate(back, 1):
        eq = masks.get(c, 0)
        x = eq | down
        h = (((eq & up) + up) ^ up) | eq
        right_up, right_down = down | (full & ~(h | up)), up & h
        d += 1 if right_up & top else -1 if right_down & top else 0
        # both strings begin here: each further character of the text costs one more
        right_up, right_down = (right_up << 1 | 1) & full, right_down << 1 & full
        up, down = right_down | (full & ~(x | right_up)), right_up & x
        if d == distance:
            options.append(i)
    return end - min(options, key=lambda n: (abs(n - m), -n))


def alone(text: str, begin: int, end: int) -> bool:
    """Whether no letter or digit touches a stretch."""
    return not (begin > 0 and text[begin - 1].isalnum() or end < len(text) and text[end].isalnum())


class Finder:
    """All items of a block, ready to be looked for. Items: (id, text)."""

    def __init__(self, items: list[tuple], error_rate: float, least_chars: int):
        import ahocorasick

        self.items = []
        where: dict[str, list[tuple[int, int]]] = {}
        for key, text in items:
            t = normal(text or "")
            if not t:
                continue
            short = len(t) < least_chars
            k = 0 if short else budget(t, error_rate)
            for offset, piece in pieces_of(t, k):
                where.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((key, t, k, masks_of(t), short))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple]:
        """(item id, least distance, start, end) in the normal form of ``text``, one per item."""
        if not self.items or not text:
            return []
        t = normal(text)
        starts: dict[int, set[int]] = {}
        for end, (size, places) in self.automaton.iter(t):
            for number, offset in places:
                starts.setdefault(number, set()).add(end - size + 1 - offset)
        found = []
        for number, begins in starts.items():
            key, item, k, masks, short = self.items[number]
            best = None
            for b in sorted(begins):
                if b >= 0 and t.startswith(item, b) and (not short or alone(t, b, b + len(item))):
                    best = (0, b, b + len(item))
                    break
            if best is None and k:
                # neighbouring windows are joined: no stretch is looked at twice
                spans: list[list[int]] = []
                for b in sorted(begins):
                    low, high = max(0, b - k), min(len(t), b + len(item) + k)
                    if spans and low <= spans[-1][1] - len(item):
                        spans[-1][1] = max(spans[-1][1], high)
                    else:
                        spans.append([low, high])
                for low, high in spans:
                    d, at = least_distance(masks, len(item), t[low:high])
                    if d <= k and (best is None or d < best[0]):
                        best = (d, -1, low + at)
                if best is not None:
                    best = (best[0], start_of(item, t, best[2], best[0]), best[2])
            if best is not None:
                found.append((key, *best))
        return sorted(found, key=lambda x: (x[0] is None, x[0] or 0, x[1:]))


FOUND = "array<struct<item:bigint,distance:int,start:int,end:int>>"
_FOUND = pa.list_(pa.struct([("item", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def _scan(items, error_rate: float, least_chars: int, column: str):
    """Puts ``column`` before the last column, the text."""

    def run(batches):
        finder = Finder(items.value, error_rate, least_chars)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            rows = [[{"item": i, "distance": d, "start": a, "end": b} for i, d, a, b in finder.find(t.as_py())] for t in texts]
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, _FOUND), texts], names=[*names[:-1], column, names[-1]])

    return run


def item_blocks(items: DataFrame, key: str, text: str, most: int = BLOCK_BYTES):
    """The test items, block after block of at most ``most`` bytes of text (or one item): the driver
    holds one block and one partition of items at a time. Where there are no items, one empty block.

    Items are a stated query set.  Null texts are left out; of rows with equal keys each is an item.
    """
    block: list[tuple] = []
    held = 0
    for r in items.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t")).where("t is not null").toLocalIterator():
        size = len(r["t"].encode())
        if held and held + size > most:
            yield block
            block, held = [], 0
        block.append((r["k"], r["t"]))
        held += size
    yield block


def contaminated(df: DataFrame, text: Column, items: DataFrame, keep: list[Column], item_key: str = "item_id", item_text: str = "text", error_rate: float = 0.06, least_chars: int = 40) -> DataFrame:
    """Columns ``keep`` with ``found``: an array of structs (item, distance, start, end), by item.

    Offsets count characters of the normal form (lower case, single spaces).  Items shorter than
    ``least_chars`` in that form are found without edits and on their own only; empty ones never.
    Null and empty texts find nothing, as does any text where there are no items.  Very long texts
    are searched whole; of several places of an item the one with the least distance counts, the
    first of equal ones.  Rows are neither merged nor shuffled: repeated rows are found alike, an
    empty table gives an empty one, a kept column called ``found`` is replaced.  Items with null ids are
    found like others and come last.  Each block of items is a pass of its own over the texts, whose
    result is written before the next, so that a worker holds one block.
    """
    spark = df.sparkSession
    small_batches(spark)
    kept = df.select(*keep).columns
    hidden, prefix = fresh(kept, "__text", "__found")
    out = df.select(*keep, text.alias(hidden))
    columns, held = [], None
    for i, block in enumerate(item_blocks(items, item_key, item_text, BLOCK_BYTES)):
        if columns:
            out = stage(out, "contaminated")
            release(held)
            held = out
        columns.append(column := f"{prefix}{i}")
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields]
        fields.insert(-1, f"`{column}` {FOUND}")
        out = out.mapInArrow(_scan(spark.sparkContext.broadcast(block), error_rate, least_chars, column), ", ".join(fields))
    found = F.array_sort(F.concat(*[F.col(c) for c in columns]))
    # null ids last
    found = F.concat(F.filter(found, lambda x: x["item"].isNotNull()), F.filter(found, lambda x: x["item"].isNull()))
    return out.select(*[F.col(f"`{c}`") for c in kept if c.lower() != "found"], found.alias("found"))
