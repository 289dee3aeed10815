"""Recurring lines by a log-template tree.

A line's way through the tree has a fixed depth: its number of tokens, then its leading tokens, where
a token that holds a digit counts as a variable field.  Lines of one leaf may have several templates:
a template keeps the tokens that are most common in the leaf at the positions after the leading
tokens (``similarity`` of them, one that is no field at least), other positions are variable fields.
A line without one is a template of its own (with digits as variable fields).  Templates are found
in rounds, the lines of those found taken out of the next.  Templates that occur in
``min_docs`` documents are dropped from all of them, long ones from ``long_docs`` documents on.

Templates are found from counts alone, in no order of arrival: equal lines are added up first, and
only leaves with several different lines are looked at token by token, one line for each different
one.  A leaf of up to ``LEAF_LINES`` different lines and ``LEAF_TOKENS`` tokens is worked on as a whole by one task; larger ones
by the same steps as joins and aggregations, so that none is in one task.
"""

from __future__ import annotations

import functools
import math
import re
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .workspace import fresh, release, small_batches, stage

FIELD = "<*>"
_DIGIT = re.compile(r"\d")
#: Different lines of a leaf that one task may hold, and tokens in all of them (about 240 bytes each).
LEAF_LINES = 10_000
LEAF_TOKENS = 1_000_000


def masked(line: str) -> list[str]:
    tokens = line.split()
    return [FIELD if _DIGIT.search(t) else t for t in tokens] if _DIGIT.search(line) else tokens


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def _addresses(depth: int, min_tokens: int, min_docs: int, long_tokens: int, long_docs: int):
    """(key, digest, leaf, line, least, numbers, tokens) of each different masked line of each row;
    ``least`` is the number of documents from which on its line or template recurs. Lines of fewer
    than ``min_tokens`` tokens are not masked and have a leaf of their own. Tokens are 32-bit hashes."""
    import xxhash

    hash64, hash32 = xxhash.xxh3_64_intdigest, xxhash.xxh32_intdigest

    def run(batches, most: int = 50_000):
        names = ["key", "digest", "leaf", "line", "least", "numbers", "tokens"]
        types = [None, pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32())]
        # tokens are hashed anew wherever they stand: that is cheaper than to look them up
        rows, flat, ends = [], array("I"), [0]

        def made():
            signed = (np.array(flat, np.uint32) ^ np.uint32(1 << 31)).view(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(signed))
            return pa.RecordBatch.from_arrays([*(pa.array([r[j] for r in rows], t) for j, t in enumerate(types)), tokens], names=names)

        for batch in batches:
            types[0] = batch.column(0).type
            for i, text in enumerate(batch.column(2)):
                if not text.is_valid:
                    continue
                lines: dict[tuple[int, int, int], list[int]] = {}
                for number, line in enumerate(text.as_py().split("\n")):
                    tokens = masked(line)
                    if not tokens:
                        continue
                    short = len(tokens) < min_tokens
                    leading = ["short", *line.split()] if short else [str(len(tokens)), *tokens[:depth]]
                    leaf = _signed(hash64(" ".join(leading)))
                    whole = leaf if short else _signed(hash64(" ".join(tokens)))
                    least = min(min_docs, long_docs) if len(tokens) >= long_tokens else min_docs
                    address = (leaf, whole, least)
                    if address in lines:
                        lines[address].append(number)
                        continue
                    lines[address] = [number]
                    if not short:
                        flat.extend(map(hash32, tokens))
                    ends.append(len(flat))
                key, digest = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows += [(key, digest, *address, numbers) for address, numbers in lines.items()]
                if len(rows) > most:
                    yield made()
                    rows, flat, ends = [], array("I"), [0]
            if rows:
                yield made()
                rows, flat, ends = [], array("I"), [0]

    return run


def _token(token: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(token.encode("utf-8", "surrogatepass")) - (1 << 31)


def _field():
    return F.lit(_token(FIELD))


def leaf_members(tokens: np.ndarray, docs: list[int], holders: list, least: int, depth: int, similarity: float) -> set[int]:
    """Positions of those lines of a leaf that belong to a template.

    tokens: a row for each different line; docs: how many documents hold it; holders: their digests,
    needed for lines in fewer than ``least`` documents.  Each round: a line's key are its most common
    tokens after the leading ones, with their positions, as many as must agree; the lines of a key
    are a group, and groups of enough documents make templates, as does the whole rest.  Lines that
    agree with a template are taken out, and the rest is counted anew, until nothing is found.
    """
    field = _token(FIELD)
    tail = tokens[:, depth:]
    width = tail.shape[1]
    need = max(1, math.ceil(round(similarity * width, 6)))
    members: set[int] = set()
    if width < need:
        return members
    weight = np.array(docs, np.int64)

    def recurs(lines) -> bool:
        if any(docs[i] >= least for i in lines):
            return True
        apart: set[int] = set()
        for i in lines:
            apart.update(holders[i])
        return len(apart) >= least

    def agreeing(lines: list[int]) -> list[int]:
        """Lines of the rest that agree with the template of ``lines``."""
        own, of = tail[lines], weight[lines]
        half = of.sum() / 2
        # the only token of a position that can have more than half of the documents: the one at half of them
        sort = np.argsort(own, axis=0)
        middle = (np.cumsum(of[sort], axis=0) > half).argmax(axis=0)
        template = np.take_along_axis(own, np.take_along_axis(sort, middle[None], 0), 0)[0]
        fixed = of @ (own == template) > half
        open_ = tail[rest]
        same = (open_ == template) & fixed
        # leading tokens are common to the leaf and tell nothing; nor do fields alone
        ok = (same.sum(axis=1) >= need) & (same & (open_ != field)).any(axis=1)
        return [rest[i] for i in np.flatnonzero(ok)]

    rest = list(range(len(tokens)))
    while rest:
        votes: dict[tuple[int, int], int] = {}
        spelt = [list(enumerate(row)) for row in tail[rest].tolist()]
        for places, n in zip(spelt, weight[rest].tolist(), strict=True):
            for p in places:
                votes[p] = votes.get(p, 0) + n
        groups: dict[frozenset, list[int]] = {}
        for i, places in zip(rest, spelt, strict=True):
            common = sorted((-votes[p], *p) for p in places if votes[p] >= least)
            lead = next((c for c in common if c[2] != field), None)
            if lead is not None and len(common) >= need:
                groups.setdefault(frozenset([lead, *[c for c in common if c != lead][: need - 1]]), []).append(i)
        found: set[int] = set()
        for lines in groups.values():
            if recurs(lines):
                found.update(agreeing(lines))
        whole = agreeing(rest)
        if whole and recurs(whole):
            found.update(whole)
        if not found:
            break
        members |= found
        rest = [i for i in rest if i not in found]
    return members


def _by_leaf(depth: int, similarity: float):
    """(leaf, line) of the members among rows (leaf, line, docs, least, tokens, holders) sorted by leaf."""

    def run(batches):
        rows: list[tuple] = []

        def settle():
            tokens = np.array([r[4] for r in rows], np.int64)
            at = leaf_members(tokens, [r[2] for r in rows], [r[5] for r in rows], rows[0][3], depth, similarity) if len(rows) > 1 else ()
            found = [(rows[i][0], rows[i][1]) for i in sorted(at)]
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["leaf", "line"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and rows[0][0] != row[0]:
                    yield settle()
                    rows = []
                rows.append(row)
        if rows:
            yield settle()

    return run


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, numbers: pd.Series) -> pd.Series:
    def one(t, gone):
        if t is None or gone is None:
            return t
        gone = set(gone)
        return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)

    return pd.Series([one(t, n) for t, n in zip(text, numbers, strict=True)], dtype=object)


def _templates(weighed: DataFrame, by: list[str], depth: int) -> DataFrame:
    """(*by, template) of rows with docs and tokens: at each position from ``depth`` on the token
    that more than half of the documents have, else null."""
    votes = weighed.select(*by, "docs", F.posexplode("tokens").alias("at", "token")).where(F.col("at") >= depth)
    votes = votes.groupBy(*by, "at", "token").agg(F.sum("docs").alias("docs"))
    most = votes.groupBy(*by, "at").agg(F.max(F.struct("docs", "token")).alias("top"), F.sum("docs").alias("all"))
    token = F.when(F.col("top.docs") * 2 > F.col("all"), F.col("top.token"))
    # every position has one row here, so the rows in order are the template
    return most.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", token.alias("token")))), lambda x: x["token"]).alias("template"))


def _recurs(lines: DataFrame, members: DataFrame, by: list[str]) -> DataFrame:
    """``by`` of the members (leaf, line, ...) that occur in enough different documents together."""
    apart = lines.join(members, ["leaf", "line"]).select(*by, "key", "digest", "least").distinct()
    return apart.groupBy(*by).agg(F.count(F.lit(1)).alias("docs"), F.min("least").alias("least")).where("docs >= least").select(*by)


def _large_leaves(shown: DataFrame, lines: DataFrame, depth: int, similarity: float) -> DataFrame:
    """(leaf, line) of the lines that belong to a template, by the steps of ``leaf_members``.

    shown: (leaf, line, docs, least, tokens); lines: (leaf, line, key, digest, least), by document.
    """
    rest = shown
    found: list[DataFrame] = []
    need = F.greatest(F.lit(1), F.ceil(F.round(similarity * (F.size("tokens") - depth), 6))).cast("int")

    def agrees(template):
        tokens = F.slice("tokens", depth + 1, F.greatest(F.size("tokens") - depth, F.lit(0)))
        kept = F.filter(F.zip_with(tokens, template, lambda t, x: F.when(t == x, t)), lambda t: t.isNotNull())
        # leading tokens are common to the leaf and tell nothing; nor do fields alone
        return (F.size(kept) >= need) & F.exists(kept, lambda t: t != _field())

    while True:
        pairs = rest.select("leaf", "line", "docs", "least", need.alias("need"), F.posexplode("tokens").alias("at", "token")).where(F.col("at") >= depth)
        votes = pairs.groupBy("leaf", "at", "token").agg(F.sum("docs").alias("votes"), F.min("least").alias("least")).where("votes >= least").drop("least")
        # a token that is no field comes first
        order = F.struct((-F.col("votes")).alias("votes"), "at", "token")
        ranked = pairs.join(votes, ["leaf", "at", "token"]).groupBy("leaf", "line", "docs", "least", "need").agg(F.array_sort(F.collect_list(order)).alias("common"))
        ranked = ranked.withColumn("lead", F.get(F.filter("common", lambda p: p["token"] != _field()), F.lit(0))).where("lead is not null and size(common) >= need")
        key = F.concat(F.array("lead"), F.slice(F.filter("common", lambda p: p != F.col("lead")), 1, F.col("need") - 1))
        ranked = stage(ranked.select("leaf", "line", "docs", "least", F.xxhash64(F.array_sort(key)).alias("group")), "lines-keys")
        enough = ranked.groupBy("leaf", "group").agg(F.sum("docs").alias("docs"), F.min("least").alias("least")).where("docs >= least").select("leaf", "group")
        groups = _recurs(lines, ranked.join(enough, ["leaf", "group"]).select("leaf", "line", "group"), ["leaf", "group"])
        own = ranked.join(groups, ["leaf", "group"]).select("leaf", "line", "group").join(rest, ["leaf", "line"])
        several = _templates(own, ["leaf", "group"], depth).groupBy("leaf").agg(F.collect_list("template").alias("templates"))
        grouped = rest.join(several, "leaf").where(F.exists("templates", agrees)).select("leaf", "line")
        whole = rest.join(_templates(rest, ["leaf"], depth), "leaf").where(agrees(F.col("template"))).select("leaf", "line")
        whole = stage(whole, "lines-whole")
        whole = whole.join(_recurs(lines, whole, ["leaf"]), "leaf").select("leaf", "line")
        new = stage(grouped.unionAll(whole).distinct(), "lines-members")
        if new.isEmpty():
            return functools.reduce(DataFrame.unionAll, found, new)
        found.append(new)
        rest = stage(rest.join(new.select("leaf").distinct(), "leaf", "left_semi").join(new, ["leaf", "line"], "left_anti"), "lines-rest")


def recurring(df: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = 5, depth: int = 2, similarity: float = 0.6, min_tokens: int = 4, long_tokens: int = 50, long_docs: int = 2) -> DataFrame:
    """(key, digest, numbers): for each row that has any, the numbers (from 0) of its lines whose
    template occurs in at least ``min_docs`` rows, ``long_docs`` for lines of ``long_tokens`` tokens
    or more. ``digest`` is ``xxhash64(text)``."""
    docs = df.select(df[key].alias("key"), F.xxhash64(df[text]).alias("digest"), df[text].alias("text")).where("text is not null")
    kind = df.schema[key].dataType.simpleString()
    lines = stage(docs.mapInArrow(_addresses(depth, min_tokens, min_docs, long_tokens, long_docs), f"key {kind}, digest bigint, leaf bigint, line bigint, least int, numbers array<int>, tokens array<int>"), "lines")

    different = stage(lines.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("docs"), F.min("least").alias("least")), "lines-different")
    open_ = different.groupBy("leaf").agg(F.count(F.lit(1)).alias("kinds"), F.sum("docs").alias("all"), F.min("least").alias("least")).where("kinds > 1 and all >= least").select("leaf", "kinds")
    open_ = stage(lines.select("leaf", "line", "key", "digest", "least", "tokens").join(open_, "leaf"), "lines-open")
    # lines in enough documents recur on their own; of others all documents are named: fewer than ``least``
    holder = F.when(F.col("docs") < F.col("least"), F.xxhash64("key", "digest"))
    shown = open_.join(different.select("leaf", "line", "docs"), ["leaf", "line"]).groupBy("leaf", "line")
    shown = stage(shown.agg(F.max("docs").alias("docs"), F.max("least").alias("least"), F.first("tokens").alias("tokens"), F.collect_set(holder).alias("holders"), F.max("kinds").alias("kinds")), "lines-shown")

    # the lines of a leaf have equally many tokens
    fits = (F.col("kinds") <= LEAF_LINES) & (F.col("kinds") * F.coalesce(F.size("tokens"), F.lit(0)) <= LEAF_TOKENS)
    small = shown.where(fits).select("leaf", "line", "docs", "least", "tokens", "holders")
    often = different.where("docs >= least").select("leaf", "line")
    often = often.unionAll(small.repartition("leaf").sortWithinPartitions("leaf", "line").mapInArrow(_by_leaf(depth, similarity), "leaf bigint, line bigint"))
    large = shown.where(~fits)
    if not large.isEmpty():
        often = often.unionAll(_large_leaves(large.select("leaf", "line", "docs", "least", "tokens"), open_.where(~fits), depth, similarity))
    often = stage(often.distinct(), "lines-often")
    release(different, open_, shown)
    dropped = lines.join(often, ["leaf", "line"]).select("key", "digest", F.explode("numbers").alias("number"))
    return dropped.groupBy("key", "digest").agg(F.collect_set("number").alias("numbers"))


def drop_recurring(df: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``df`` with ``text`` cleaned of recurring lines, and ``n_dropped``, the lines dropped.

    Every row counts as a document, repeated rows too (where several lines make a template, rows that
    are equal count once); within a row a repeated line counts once and all of its copies go.  Very
    long texts and lines are read whole.  Lines of fewer than ``min_tokens`` tokens go where they recur exactly
    (white space aside), blank ones stay.  Null texts stay null, an empty table stays empty, a null key
    is a key like others.  An input column called ``n_dropped`` is replaced.
    """
    small_batches(df.sparkSession)
    found = recurring(df, key, text, **how)
    k, d, n = fresh(df.columns, "__key", "__digest", "__numbers")
    found = found.select(F.col("key").alias(k), F.col("digest").alias(d), F.col("numbers").alias(n))
    out = df.join(found, df[key].eqNullSafe(F.col(k)) & (F.xxhash64(df[text]) == F.col(d)), "left")
    out = out.withColumn(text, _without(F.col(text), F.col(n))).withColumn("n_dropped", F.when(F.col(n).isNull(), 0).otherwise(F.size(n)))
    return out.drop(k, d, n)
