"""Language identification by words first, character n-grams for unseen words.

Training counts every word of every labelled row in Arrow batches and adds the batches' counts.  The
model keeps the words and n-grams that are most frequent over all languages, each with its counts in
every language, as far as its capacity goes: ``most_entries`` (unit, language) pairs of words and as
many of n-grams, which bounds what is broadcast.  The cut follows from a table of how many units have
which count, so nothing is ranked; units of one count are kept or left out together.  A word in the
model scores each language by its smoothed log frequency there.  Any other word takes the longest
n-grams, of ``longest`` characters down to one, of which the model knows one at least, and scores
their mean.

A model is held as sorted 64-bit digests of units and, for each, the languages that have it with the
logarithm of what it gains over a unit that the language lacks.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import fresh, release, small_batches, stage

#: Letters and the marks, in any script, that Python counts as word characters.
_WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: Added to every count.
ALPHA = 0.5
#: An unseen word is known if the model has this share of its n-grams of KNOWN_GRAM or more characters
#: (with the spaces around the word), of one size.
KNOWN_GRAM, KNOWN_SHARE = 4, 0.8


def words_of(text: str) -> list[str]:
    return [w for w in _WORD.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))]


def grams_of(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)] if n > 1 else list(word)


def _count(batches, limit: int = 200_000):
    """(lang, word, n) of each batch's rows; counts are passed on when ``limit`` words are held."""
    held: dict[str, Counter] = {}

    def flush():
        rows = [(lang, w, n) for lang, c in held.items() for w, n in c.items()]
        held.clear()
        for i in range(0, len(rows), 50_000):
            part = rows[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.string()), pa.array([r[1] for r in part], pa.string()), pa.array([r[2] for r in part], pa.int64())], names=["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            held.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
        if sum(map(len, held.values())) > limit:
            yield from flush()
    yield from flush()


def _count_grams(longest: int, limit: int = 200_000):
    """(lang, unit, n) of the n-grams of counted words."""

    def run(batches):
        held: dict[str, dict[str, int]] = {}

        def flush():
            for lang, counts in held.items():
                grams, ns = list(counts), list(counts.values())
                for i in range(0, len(grams), 50_000):
                    part = grams[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part, pa.string()), pa.array(ns[i : i + 50_000], pa.int64())], names=["lang", "unit", "n"])
            held.clear()

        for batch in batches:
            for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                counts = held.setdefault(lang, {})
                for size in range(1, longest + 1):
                    for g in grams_of(word, size):
                        counts[g] = counts.get(g, 0) + n
            if sum(map(len, held.values())) > limit:
                yield from flush()
        yield from flush()

    return run


def _added(counts: DataFrame) -> DataFrame:
    """(lang, unit, n) with equal rows added up, rows of a unit in one partition. Workers have added
    up what they could, so a common unit has few rows."""
    return counts.repartition("unit").groupBy("unit", "lang").agg(F.sum("n").alias("n")).select("lang", "unit", "n")


def least_kept(kinds: dict[int, int], most: int) -> int:
    """Least count from which on units are kept, so that ``most`` entries are not exceeded.
    kinds: count -> entries of the units with that count."""
    held, least = 0, max(kinds, default=0) + 1
    for count in sorted(kinds, reverse=True):
        held += kinds[count]
        if held > most:
            break
        least = count
    return least


def _entries(counts: DataFrame, most: int) -> pa.Table:
    """(unit, lang, n) of the kept units, the unit as its digest: at most ``most`` rows."""
    units = counts.groupBy("unit").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by"))
    # exact counts up to 65,535, powers of two above: a bounded number of rows for the driver
    total = F.when(F.col("total") < 65_536, F.col("total")).otherwise(F.pow(F.lit(2.0), F.floor(F.log2("total"))).cast("bigint"))
    units = stage(units.select(F.xxhash64("unit").alias("unit"), total.alias("total"), "by"), "langid-units")
    kinds = {r["total"]: r["n"] for r in units.groupBy("total").agg(F.sum(F.size("by")).alias("n")).collect()}
    kept = units.where(F.col("total") >= least_kept(kinds, most)).select("unit", F.explode("by").alias("x")).select("unit", "x.lang", "x.n").toArrow()
    release(units)
    return kept


def _sums(counts: DataFrame, *by: str) -> dict[tuple, tuple[int, int]]:
    """Occurrences and different units for each language (and ``by``)."""
    rows = counts.groupBy("lang", *by).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()
    return {(r["lang"], *(r[c] for c in by)): (r["n"], r["kinds"]) for r in rows}


def _table(entries: pa.Table, at: dict[str, int]) -> tuple:
    """(units, starts, languages, gains): sorted digests, and for each its languages and gains."""
    unit = entries["unit"].to_numpy()
    lang = np.array([at[x] for x in entries["lang"].to_pylist()], np.int32)
    gain = np.log((entries["n"].to_numpy() + ALPHA) / ALPHA)
    order = np.lexsort((lang, unit))
    units, starts = np.unique(unit[order], return_index=True)
    return units, np.append(starts, len(order)).astype(np.int64), lang[order], gain[order].astype(np.float32)


def train(df: DataFrame, text: str, lang: str, most_entries: int = 500_000, longest: int = 5) -> dict:
    """Model of all rows whose text and language are not null.

    Of words, and of n-grams, those are kept that are most frequent over all languages, at most
    ``most_entries`` pairs of a unit and a language; where there are no more, all are kept.  Reruns
    agree.  An empty table gives a model without languages.  The number of languages is not bounded:
    for each, one row of ``longest + 1`` sums reaches the driver.
    """
    small_batches(df.sparkSession)
    labelled = df.select(df[lang].cast("string").alias("lang"), df[text].alias("text")).where("lang is not null and text is not null")
    words = stage(_added(labelled.mapInArrow(_count, "lang string, unit string, n bigint")), "langid-words")
    grams = stage(_added(words.mapInArrow(_count_grams(longest), "lang string, unit string, n bigint")), "langid-grams")
    own, sized = _sums(words), _sums(grams.withColumn("size", F.length("unit")), "size")
    langs = sorted({k[0] for k in own})
    at = {name: i for i, name in enumerate(langs)}
    base = np.zeros((longest + 1, len(langs)))
    for name, i in at.items():
        for size in range(longest + 1):
            n, kinds = own[(name,)] if size == 0 else sized.get((name, size), (0, 0))
            base[size, i] = math.log(ALPHA / (n + ALPHA * (kinds + 1)))
    model = {"langs": langs, "longest": longest, "base": base, "words": _table(_entries(words, most_entries), at), "grams": _table(_entries(grams, most_entries), at)}
    release(words, grams)
    return model


def _digests(units: list[str]) -> np.ndarray:
    """What ``xxhash64`` gives in SQL."""
    import xxhash

    h = xxhash.xxh64_intdigest
    return np.array([h(u.encode("utf-8", "surrogatepass"), 42) for u in units], np.uint64).view(np.int64)


class _Scored:
    """Scores of the words met so far, one row each, and whether they are known; forgotten when
    ``cells`` numbers are held.  New words of a batch are looked up together."""

    def __init__(self, model: dict, cells: int = 1_000_000):
        self.langs, self.longest, self.base = model["langs"], model["longest"], model["base"]
        self.words, self.grams = model["words"], model["grams"]
        self.most = max(10_000, cells // max(1, len(self.langs)))
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.rows, self.known, self.used = np.zeros((1024, len(self.langs))), np.zeros(1024, bool), 0

    @staticmethod
    def _find(table: tuple, digests: np.ndarray) -> np.ndarray:
        """Positions in the table's units, -1 where there is none."""
        units = table[0]
        if not len(units):
            return np.full(len(digests), -1)
        at = np.minimum(np.searchsorted(units, digests), len(units) - 1)
        return np.where(units[at] == digests, at, -1)

    @staticmethod
    def _add(made: np.ndarray, rows: np.ndarray, table: tuple, at: np.ndarray, weight: np.ndarray) -> None:
        """Add the gains of the units ``at``, each times its weight, to their rows."""
        _, starts, langs, gains = table
        n = starts[at + 1] - starts[at]
        places = np.arange(n.sum()) + np.repeat(starts[at] - (np.cumsum(n) - n), n)
        np.add.at(made, (np.repeat(rows, n), langs[places]), gains[places] * np.repeat(weight, n))

    def learn(self, new: list[str]) -> None:
        """Rows for distinct words that have none."""
        made, known = np.zeros((len(new), len(self.langs))), np.zeros(len(new), bool)
        at = self._find(self.words, _digests(new))
        own = np.flatnonzero(at >= 0)
        made[own], known[own] = self.base[0], True
        self._add(made, own, self.words, at[own], np.ones(len(own)))
        left = unsure = np.flatnonzero(at < 0)
        for size in range(self.longest, 0, -1):
            # words of which a longer n-gram is known are scored, but looked at until they count as known
            words = unsure if size >= KNOWN_GRAM else left
            if not len(words):
                continue
            grams = [grams_of(new[i], size) for i in words]
            n = np.array([len(g) for g in grams])
            owner = np.repeat(np.arange(len(words)), n)
            found = self._find(self.grams, _digests([g for gs in grams for g in gs]))
            owner, found = owner[found >= 0], found[found >= 0]
            hits = np.bincount(owner, minlength=len(words))
            first = np.isin(words, left) & (hits > 0)
            made[words[first]] = self.base[size]
            use = first[owner]
            self._add(made, words[owner[use]], self.grams, found[use], 1.0 / hits[owner[use]])
            left = np.setdiff1d(left, words[first], assume_unique=True)
            if size >= KNOWN_GRAM:
                known[words] = (hits > 0) & (hits >= KNOWN_SHARE * n)
                unsure = words[~known[words]]
        if self.used + len(new) > len(self.rows):
            more = max(2 * len(self.rows), self.used + len(new))
            self.rows = np.concatenate([self.rows[: self.used], np.zeros((more - self.used, len(self.langs)))])
            self.known = np.concatenate([self.known[: self.used], np.zeros(more - self.used, bool)])
        self.rows[self.used : self.used + len(new)] = made
        self.known[self.used : self.used + len(new)] = known
        self.at.update(zip(new, range(self.used, self.used + len(new)), strict=True))
        self.used += len(new)

    def totals(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the sums of its words' scores and its share of known words; no text is
        without words."""
        every = [w for t in texts for w in t]
        at = self.at
        try:
            ids = np.array([at[w] for w in every], np.int64)
        except KeyError:
            different = list(dict.fromkeys(every))
            if self.used > self.most:
                self.forget()
            self.learn([w for w in different if w not in self.at])
            at = self.at
            ids = np.array([at[w] for w in every], np.int64)
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        return np.add.reduceat(self.rows[ids], starts, axis=0), np.add.reduceat(self.known[ids].astype(float), starts) / sizes


def _predict(model, outputs: list[str], words: int = 60_000):
    def run(batches):
        scored = _Scored(model.value)
        for batch in batches:
            names, scores, shares = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows, [0.0] * batch.num_rows
            held: list[list[str]] = []
            where: list[int] = []

            def settle(names=names, scores=scores, shares=shares, held=held, where=where):
                if held:
                    totals, known = scored.totals(held)
                    best = totals.argmax(axis=1)
                    even = np.sqrt([len(t) for t in held])[:, None]
                    share = 1.0 / np.exp(np.clip((totals - totals.max(axis=1, keepdims=True)) / even, -700, 0)).sum(axis=1)
                    for i, b, x, k in zip(where, best.tolist(), share.tolist(), known.tolist(), strict=True):
                        names[i], scores[i], shares[i] = scored.langs[b], x, k
                held.clear()
                where.clear()

            size = 0
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                found = words_of(text.as_py() or "") if scored.langs else []
                if found:
                    held.append(found)
                    where.append(i)
                    size += len(found)
                    if size > words:
                        settle()
                        size = 0
            settle()
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-1] + outputs)

    return run


def predict(df: DataFrame, text: Column, model: dict, keep: list[Column], pred: str = "lang_pred", score: str = "score", known: str = "known") -> DataFrame:
    """Columns ``keep`` with ``pred``, ``score`` and ``known`` (0 to 1) of each row of ``df``; the
    names must not be among those kept.  ``known`` is the share of a text's words that the model has,
    or of whose n-grams of four or of five characters it has four fifths.

    Null texts and texts without a letter are ``und`` with score 0, as is every row where nothing
    was learned.  Ties go to the smaller language code.  The score is the best language's share of
    the likelihoods, evened by the square root of the number of words.  Very long texts are read whole,
    repeated rows stay, an empty table gives an empty one.
    """
    small_batches(df.sparkSession)
    kept = df.select(*keep).columns
    (hidden,) = fresh([*kept, pred, score, known], "__text")
    chosen = df.select(*keep, text.alias(hidden))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    shared = df.sparkSession.sparkContext.broadcast(model)
    return chosen.mapInArrow(_predict(shared, [pred, score, known]), f"{types}, `{pred}` string, `{score}` double, `{known}` double")
