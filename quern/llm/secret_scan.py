"""Secret scan: fixed patterns plus a comparison of two character Markov models.

Candidate strings are scored by the log-likelihood ratio of a first-order character model of random
strings and one of ordinary identifiers: as a whole, and by their best stretch, so that the name in
``name=value`` or ``path/value`` does not hide the value.  Both are estimated from labelled samples (values of base spans and words of sampled documents, and made ones) by DataFrame
operations; the table that reaches the driver has at most one row for each pair of the alphabet's
characters, and scoring reads it as a constant array.  All offsets count code points; ends are
exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The base patterns, their kinds in order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # runs of fewer than 18 characters fail wherever they start
HEX = r"[0-9a-f]{16,}"  # maximal runs of 16 or more
KINDS = ("assign", "access", "hex", "markov")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

WORDS = (
    "account action active address amount array batch buffer build cache client close cluster code collection column config "
    "connection container content context control counter create current customer data database default delete detail device "
    "directory document element error event example execute export factory field file filter format function group handler header "
    "history image index information input instance interface internal item iterator language length level library limit list "
    "location manager message method model module name network number object operation option order output package page parameter "
    "parser path pattern payment pointer position process product profile program project property provider query queue record "
    "reference region register release report request resource response result return route sample schema search section selection "
    "sequence server service session setting shadow source standard state status storage stream string structure support system "
    "table target template temporary thread timeout total transaction transform translation update upload user value variable "
    "version view warehouse window with without workflow writer station nation the and thing other ention tion able ment"
).split()

# Ordinary names are written in other languages too, without accents.
OTHER_WORDS = (
    "anfrage antwort benutzer datei durch eigenschaft ein einstellung fehler freiheit heit keit lich nachricht nicht rechnung schaft "
    "schnitt und ung verzeichnis zeit zugang zwischen "
    "avec connexion dans demande des donnees eau eur fichier jour les ment monde objet parametre pour quelque reponse resultat sur "
    "toujours travail une utilisateur "
    "agua archivo cion con conexion dad datos dia las los mente mundo objeto para que respuesta resultado siempre sobre solicitud "
    "trabajo usuario"
).split()


def _styled(parts: Column, key: Column) -> Column:
    """Four words as an identifier, path or constant; which spelling, and which numbers, a hash of ``key`` says."""
    low = F.transform(parts, lambda x: F.lower(x))
    caps = F.transform(parts, lambda x: F.initcap(x))
    up = F.transform(parts, lambda x: F.upper(x))
    number = F.substring(F.pmod(F.xxhash64(F.lit("n"), key), F.lit(10_000)).cast("string"), 1, 4)
    joined = lambda words, by: F.array_join(words, by)
    ways = [
        joined(low, "_"),
        joined(low, "-"),
        joined(caps, ""),
        F.concat(F.get(low, F.lit(0)), joined(F.slice(caps, 2, 3), "")),
        joined(up, "_"),
        F.concat(F.lit("/"), joined(low, "/")),
        joined(low, ""),
        joined(up, ""),
        F.concat_ws("_", F.slice(low, 1, 3), number),
        F.concat_ws("-", up, number),
        joined(caps, "/"),
        F.concat(joined(F.slice(low, 1, 2), "="), F.lit("/"), F.get(low, F.lit(2))),
    ]
    pick = F.pmod(F.xxhash64(F.lit("style"), key), F.lit(len(ways)))
    out = F.lit(None).cast("string")
    for i, way in enumerate(ways):
        out = F.when(pick == i, way).otherwise(out)
    return out


def training_samples(spark: SparkSession, docs: DataFrame | None = None, id: str = "doc_id", text: str = "text", rows: int = 6000, most_docs: int = 2000) -> DataFrame:
    """Labelled samples: (label: random or ordinary, sample).

    Random ones are ``rows`` digests, written in base 64 and 32 and as hexadecimal numbers of either case,
    and the values of all base spans of sampled documents.  Ordinary ones are the words of sampled
    documents outside base spans, four after the other, ``3 * rows`` groups of usual words of four
    languages, both in all spellings and cases of identifiers, constants and paths, and ``rows`` numbers.

    About ``most_docs`` of ``docs`` are sampled, by a hash of the id, and read whole: the classifier is fitted
    on a bounded sample.  Documents with null ids or texts are not sampled; without ``docs`` there are
    only made samples.
    """
    i = F.col("id")
    base = spark.range(rows)
    digest = F.sha2(i.cast("string").cast("binary"), 256)
    sixty_four = F.base64(F.unhex(digest))
    made = F.when(i % 4 == 0, F.substring(digest, 1, 40)).when(i % 4 == 1, F.substring(F.upper(digest), 1, 40)).when(i % 4 == 2, F.substring(F.translate(F.upper(sixty_four), "+/=0189", ""), 1, 32)).otherwise(F.substring(sixty_four, 1, 40))
    known = WORDS + OTHER_WORDS
    words = F.array(*map(F.lit, known))
    pick = lambda j: F.element_at(words, (F.pmod(F.hash(i, F.lit(j)), F.lit(len(known))) + 1).cast("int"))
    usual = spark.range(3 * rows).select(_styled(F.array(*[pick(j) for j in range(4)]), i).alias("sample"))
    numbers = base.select(F.translate(digest, "abcdef", "").alias("sample"))
    ordinary, random = usual.unionAll(numbers), base.select(made.alias("sample"))
    if docs is not None:
        t = docs.where(docs[text].isNotNull() & docs[id].isNotNull())
        every = max(1, t.count() // most_docs)
        held = t.where(F.pmod(F.xxhash64(docs[id]), F.lit(every)) == 0).select(docs[text].alias("t"))
        found = F.concat(
            F.filter(F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2)), lambda x: F.length(x) >= 12),
            F.regexp_extract_all("t", F.lit(f"({ACCESS})"), F.lit(1)),
            F.regexp_extract_all("t", F.lit(f"({HEX})"), F.lit(1)),
        )
        random = random.unionAll(held.select(F.explode(found).alias("sample")))
        rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("t", ASSIGN, " "), ACCESS, " "), HEX, " ")
        plain = held.select(F.regexp_extract_all(rest, F.lit("[A-Za-z]{2,14}"), F.lit(0)).alias("w")).where(F.size("w") >= 4)
        four = plain.select(F.posexplode(F.transform(F.sequence(F.lit(0), F.floor(F.size("w") / 4).cast("int") - 1), lambda k: F.slice("w", k * 4 + 1, F.lit(4)))).alias("at", "parts"))
        ordinary = ordinary.unionAll(four.select(_styled(F.col("parts"), F.concat(F.array_join("parts", " "), F.col("at").cast("string"))).alias("sample")))
    return random.select(F.lit("random").alias("label"), "sample").unionAll(ordinary.select(F.lit("ordinary").alias("label"), "sample"))


def train(samples: DataFrame, alphabet: str = ALPHABET, most: float = 2.5) -> list[float]:
    """Log-likelihood ratios (random over ordinary) of transitions, row-major over the alphabet.

    No transition counts more than ``most`` either way, so that a few rare pairs of letters do not make an
    ordinary name random.  Counts cover all samples; add-one smoothing; null samples and characters outside the alphabet
    are passed over.  At most ``2 * len(alphabet)**2`` counted rows are collected.
    """
    s = F.col("sample")
    pairs = F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.substring(s, i, F.lit(2)))
    known = F.transform(F.split(F.lit(alphabet), ""), lambda c: c)
    counted = (
        samples.where(F.length(s) >= 2)
        .select("label", F.explode(pairs).alias("pair"))
        .where(F.array_contains(known, F.substring("pair", 1, 1)) & F.array_contains(known, F.substring("pair", 2, 1)))
        .groupBy("label", "pair")
        .count()
        .collect()
    )
    size, at = len(alphabet), {c: i for i, c in enumerate(alphabet)}
    counts = {k: [[1.0] * size for _ in range(size)] for k in ("random", "ordinary")}
    for row in counted:
        if row["label"] in counts:
            counts[row["label"]][at[row["pair"][0]]][at[row["pair"][1]]] += row["count"]
    share = {k: [[math.log(x / sum(row)) for x in row] for row in table] for k, table in counts.items()}
    return [max(-most, min(most, share["random"][a][b] - share["ordinary"][a][b])) for a in range(size) for b in range(size)]


def _over_transitions(token: Column, ratios: list[float], alphabet: str, start: Column, step, finish=None) -> Column:
    """``step`` over the ratios of the transitions of a token made of the alphabet's characters."""
    size = len(alphabet)
    index = [0] * 128
    for i, c in enumerate(alphabet):
        index[ord(c)] = i
    codes = F.expr("cast(split('" + ",".join(map(str, index)) + "', ',') as array<int>)")
    table = F.expr("cast(split('" + ",".join(f"{r:.9g}" for r in ratios) + "', ',') as array<double>)")
    code = lambda i: F.get(codes, F.ascii(F.substring(token, i, F.lit(1))))
    return F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), start, lambda acc, i: step(acc, F.get(table, code(i) * size + code(i + 1))), finish)


def log_likelihood_ratio(token: Column, ratios: list[float], alphabet: str = ALPHABET) -> Column:
    """Sum of the transitions' ratios over a token made of the alphabet's characters."""
    return _over_transitions(token, ratios, alphabet, F.lit(0.0), lambda acc, x: acc + x)


def best_stretch(token: Column, ratios: list[float], alphabet: str = ALPHABET) -> Column:
    """Largest sum of the transitions' ratios over any stretch of a token, 0 at least."""
    both = lambda now, best: F.struct(now.alias("now"), best.alias("best"))

    def step(acc: Column, x: Column) -> Column:
        now = F.greatest(acc["now"] + x, F.lit(0.0))
        return both(now, F.greatest(acc["best"], now))

    return _over_transitions(token, ratios, alphabet, both(F.lit(0.0), F.lit(0.0)), step, lambda acc: acc["best"])


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as a lambda's variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(deltas: Column) -> Column:
    """Running totals of an array of numbers, in blocks: work for n items is n times the block
    length plus the square of the number of blocks. ``deltas`` is a variable, not an expression."""
    block = 64
    last = F.floor((F.size(deltas) - 1) / block).cast("int")
    part = lambda k: F.slice(deltas, k * block + 1, F.lit(block))

    def totals(values: Column, start: Column) -> Column:
        empty = F.array().cast("array<bigint>")
        both = lambda sofar, total: F.struct(sofar.alias("sofar"), total.alias("total"))
        return F.aggregate(values, both(empty, start), lambda a, x: both(F.concat(a["sofar"], F.array(a["total"] + x)), a["total"] + x), lambda a: a["sofar"])

    zero = F.lit(0).cast("bigint")
    sums = F.transform(F.sequence(F.lit(0), last), lambda k: F.aggregate(part(k), zero, lambda a, x: a + x))
    before = F.concat(F.array(zero), totals(sums, zero))
    return _bound(before, lambda b: F.flatten(F.transform(F.sequence(F.lit(0), last), lambda k: totals(part(k), F.get(b, k)))))


def spans_of(text: Column, pattern: str, kind: str, keep) -> Column:
    """Leftmost non-overlapping matches as structs (start, kind, end) for which ``keep(match)`` holds.

    The text between matches comes from splitting at the same pattern; the running sum of both
    lengths gives the offsets.
    """
    number = KINDS.index(kind)

    def located(m: Column, gaps: Column) -> Column:
        deltas = F.zip_with(gaps, F.concat(F.array(F.lit(0)), F.transform(m, lambda x: F.length(x))), lambda g, n: (F.length(g) + n).cast("bigint"))
        spans = lambda starts: F.zip_with(F.slice(starts, 1, F.size(m)), m, lambda s, x: F.struct(s.alias("start"), F.lit(number).alias("kind"), (s + F.length(x)).alias("end"), x.alias("match")))
        made = _bound(deltas, lambda d: _bound(_running(d), spans))
        return F.transform(F.filter(made, lambda x: keep(x["match"])), lambda x: F.struct(x["start"], x["kind"], x["end"]))

    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    one = lambda m: F.when(F.size(F.filter(m, keep)) > 0, _bound(F.split(text, pattern, -1), lambda gaps: located(m, gaps))).otherwise(none)
    return _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), one)


def scan(df: DataFrame, text: str, ratios: list[float], threshold: float = 9.0, out: str = "secrets", stretch: float = 11.0) -> DataFrame:
    """``df`` with an array column ``out`` of structs (start, kind, end), by start, then kind.

    ``kind`` is a position in ``KINDS``; ``markov`` spans are runs of 20 or more characters of the
    alphabet whose ratio is at least ``threshold``, or the ratio of whose best stretch is at least
    ``stretch`` (higher, as the best of many is looked at); the span is the whole run.  Null and empty texts have an empty array.  An
    input column called ``out`` is replaced.  Rows are neither shuffled nor merged.
    """
    t = F.coalesce(df[text], F.lit(""))
    group2 = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12
    always = lambda m: F.lit(True)
    random = lambda m: (log_likelihood_ratio(m, ratios) >= threshold) | (best_stretch(m, ratios) >= stretch)
    parts = [spans_of(t, ASSIGN, "assign", group2), spans_of(t, ACCESS, "access", always), spans_of(t, HEX, "hex", always), spans_of(t, CANDIDATE, "markov", random)]
    return df.withColumn(out, F.array_sort(F.concat(*parts)))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
