"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens.

The distinct pre-tokens of a batch are walked in sorted order, which is the depth-first order of
their trie: the forward scores (best log-probability of the prefix) of a shared prefix are computed
once and stay on the stack for every pre-token below it.  A pre-token's count is that of its
terminal node.  Counts are remembered across batches up to a fixed number of pre-tokens.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import fresh, small_batches

SPACE = "▁"
#: Pre-tokens: a word with the space before it, a run of spaces, or one other white-space character.
_PRE = re.compile(f"{SPACE}?[^{SPACE}\\s]+|{SPACE}+|\\s")


def read_vocabulary(path: str) -> dict:
    """Pieces of a sentencepiece model file: {"pieces": {piece: score}, "bytes": [256 scores]}.

    Where the file ranks pieces instead of giving probabilities (its scores are whole numbers), the
    score of the piece of rank r is the logarithm of a harmonic share, ``-log((r + 1) * H)``.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    own = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    ranked = all(float(sp.get_score(i)).is_integer() for i in own)
    harmonic = sum(1 / (r + 1) for r in range(len(own)))
    by_score = sorted((i for i in own if not sp.is_byte(i)), key=lambda i: (-sp.get_score(i), i))
    score = {i: -math.log((r + 1) * harmonic) for r, i in enumerate(by_score)} if ranked else {i: sp.get_score(i) for i in by_score}
    least = min(score.values(), default=-10.0) - 1.0
    return {"pieces": {sp.id_to_piece(i): s for i, s in score.items()}, "byte": least}


def pre_tokens(text: str) -> list[str]:
    return _PRE.findall(SPACE + text.replace(" ", SPACE)) if text else []


class Counter:
    """Tokens of pre-tokens under a vocabulary; ties in score go to fewer tokens."""

    def __init__(self, vocabulary: dict, most: int = 400_000):
        self.pieces, self.byte, self.most = vocabulary["pieces"], vocabulary["byte"], most
        self.longest = max(map(len, self.pieces), default=1)
        #: Lengths of the pieces that end with a given pair of characters.
        lengths: dict[str, set[int]] = {}
        for p in self.pieces:
            if len(p) > 1:
                lengths.setdefault(p[-2:], set()).add(len(p))
        self.lengths = {k: sorted(v) for k, v in lengths.items()}
        self.known: dict[str, int] = {}

    def learn(self, words) -> None:
        """Walk the trie of ``words``, which are distinct, depth first."""
        pieces, lengths, byte, known = self.pieces, self.lengths, self.byte, self.known
        score, count, before = [0.0], [0], ""
        for w in sorted(words):
            depth, least = 0, min(len(w), len(before))
            while depth < least and w[depth] == before[depth]:
                depth += 1
            del score[depth + 1 :], count[depth + 1 :]
            for end in range(depth + 1, len(w) + 1):
                c = w[end - 1]
                s = pieces.get(c)
                if s is None:
                    n = len(c.encode("utf-8", "surrogatepass"))
                    best, number = score[end - 1] + n * byte, count[end - 1] + n
                else:
                    best, number = score[end - 1] + s, count[end - 1] + 1
                if end > 1:
                    for size in lengths.get(w[end - 2 : end], ()):
                        if size > end:
                            break
                        s = pieces.get(w[end - size : end])
                        if s is not None:
                            at = end - size
                            s += score[at]
                            if s > best or s == best and count[at] + 1 < number:
                                best, number = s, count[at] + 1
                score.append(best)
                count.append(number)
            known[w] = count[len(w)]
            before = w

    def count(self, texts: list) -> list[int]:
        split = [pre_tokens(t or "") for t in texts]
        if len(self.known) > self.most:
            self.known.clear()
        new = {w for ws in split for w in ws if w not in self.known}
        self.learn(new)
        get = self.known.__getitem__
        return [sum(map(get, ws)) for ws in split]


def _batches(vocabulary, chars: int = 4_000_000):
    def run(batches):
        counter = Counter(vocabulary.value)
        for batch in batches:
            counts, held, size = [], [], 0
            for t in batch.column(batch.num_columns - 1):
                held.append(t.as_py())
                size += len(held[-1] or "")
                if size > chars:
                    counts += counter.count(held)
                    held, size = [], 0
            counts += counter.count(held)
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-1] + ["n_tokens"])

    return run


def count_tokens(df: DataFrame, text: Column, vocabulary: dict, keep: list[Column]) -> DataFrame:
    """Columns ``keep`` with ``n_tokens``, the tokens of each row's whole text.

    A space is put before the text, spaces count as part of the word that follows, and no piece
    reaches over two pre-tokens.  Characters that the vocabulary lacks count their UTF-8 bytes.
    Null and empty texts have 0 tokens; very long ones are counted whole; an empty table gives an
    empty one.  Rows stay as they are, repeated ones too: there is no shuffle.  A kept column called
    ``n_tokens`` is replaced.  The broadcast vocabulary is that of a file, whatever the input's size.
    """
    small_batches(df.sparkSession)
    names = df.select(*keep).columns
    (hidden,) = fresh([*names, "n_tokens"], "__text")
    chosen = df.select(*[c for c, name in zip(keep, names, strict=True) if name.lower() != "n_tokens"], text.alias(hidden))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    return chosen.mapInArrow(_batches(shared), f"{types}, n_tokens bigint")


def totals(counts: DataFrame, by: str) -> DataFrame:
    """Documents and tokens per value of ``by`` (null is a value)."""
    return counts.groupBy(by).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def default_vocabulary(spark: SparkSession, path: str | None = None) -> dict:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return read_vocabulary(path)
