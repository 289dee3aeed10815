import collections
import math
import random
import time

import pyarrow as pa
import xxhash

from quern.llm import line_templates as L

from .helpers import clashing, docs, empty


def _run(df, **how):
    return {r["doc_id"]: (r["text"], r["n_dropped"]) for r in L.drop_recurring(df, **how).collect()}


def _rows(texts):
    return [(i, t, "en", "s", 0) for i, t in enumerate(texts)]


def test_exact_masked_and_generalised_lines_go(spark):
    words = "alpha beta gamma delta epsilon zeta".split()
    texts = [f"own line number {w} of {w}{w} stays here\nPosted by {w} on the board today\ncall 555-{i} now or later\nsame line in all of them" for i, w in enumerate(words)]
    got = _run(docs(spark, _rows(texts)), min_docs=5)
    for i, w in enumerate(words):
        assert got[i][1] >= 3
        assert "same line" not in got[i][0] and "Posted by" not in got[i][0] and "call" not in got[i][0]


def test_rare_lines_stay(spark):
    texts = ["one two three four\nfive six seven eight", "one two three four\nnine ten eleven twelve", "a b c\nshort"]
    got = _run(docs(spark, _rows(texts)), min_docs=3)
    assert all(n == 0 for _, n in got.values()) and got[0][0] == texts[0]


def test_leading_tokens_alone_are_no_template(spark):
    ends = "a it.|heing is.|onenly. was|thth es|7 anor.|8 ndned.".split("|")
    texts = [f"From ou {e}\nOf that {i} then {e}" for i, e in enumerate(ends)]
    got = _run(docs(spark, _rows(texts)), min_docs=5)
    assert all(n == 0 for _, n in got.values())


def test_long_lines_from_two_documents_on_and_short_ones_as_they_are(spark):
    passage = " ".join(f"w{chr(97 + i % 26)}{i // 26 * 'x'}" for i in range(50))
    short = passage.rsplit(" ", 1)[0]
    texts = [f"{passage}\n{short}\nRead more", f"own\n{passage} \n{short}\n\nRead  more", *[f"Read more\n\nPart {i}" for i in range(3)]]
    got = _run(docs(spark, _rows(texts)))
    assert got == {0: (short, 2), 1: (f"own\n{short}\n", 2), **{i + 2: (f"\nPart {i}", 1) for i in range(3)}}


def test_several_templates_of_a_leaf(spark):
    # no token after the leading ones has a majority, and one name is as common as the fixed words
    names = "ann bob cid dan eve fay gus hal".split()
    kinds = ["Posted by {} in the red room", "Posted by {} on a blue board", "Posted by {} at my own home", "Posted by {} under that old tree"]
    texts = [k.format(n) for n in names for k in kinds] + ["Posted by ann with some other words"]
    got = _run(docs(spark, _rows(texts)), min_docs=5)
    assert [n for _, n in got.values()] == [1] * 32 + [0]


def _lines(seed):
    rng = random.Random(seed)
    heads = ["Posted by", "Part 3", "see also"]
    tails = [["in", "the", "red", "room"], ["on", "a", "blue", "board"], ["at", "9", "my", "home"], ["x", "y", "z", "q"]]
    out = []
    for i in range(260):
        tail = list(rng.choice(tails))
        for at in range(4):
            if rng.random() < 0.35:
                tail[at] = rng.choice(["red", "the", "7", "ann", "bob", f"w{i}"])
        out.append(" ".join([rng.choice(heads), *tail, *rng.choices(["far", "near"], k=rng.randrange(3))]))
    return ["\n".join(rng.choices(out, k=rng.randrange(1, 4))) for _ in range(120)]


def plain(texts, min_docs, depth=2, similarity=0.6):
    """Lines that recur, each leaf and each round counted anew from the lines themselves."""
    leaves = {}
    for i, t in enumerate(texts):
        for line in t.split("\n"):
            m = tuple("<*>" if any(c.isdigit() for c in w) else w for w in line.split())
            leaves.setdefault((len(m), m[:depth]), {}).setdefault(m, set()).add(i)
    gone = {m for leaf in leaves.values() for m, held in leaf.items() if len(held) >= min_docs}
    for leaf in leaves.values():
        rest = dict(leaf)

        def votes(of):
            n = collections.Counter()
            for m in of:
                n.update(dict.fromkeys([(at, w) for at, w in enumerate(m) if at >= depth], len(rest[m])))
            return n

        def matching(of):
            n, whole = votes(of), sum(len(rest[m]) for m in of)
            fixed = {p for p, c in n.items() if 2 * c > whole}
            out = set()
            for m in rest:
                same = [w for at, w in enumerate(m) if (at, w) in fixed]
                if len(same) >= max(1, math.ceil(round(similarity * (len(m) - depth), 6))) and any(w != "<*>" for w in same):
                    out.add(m)
            return out

        while rest:
            n, groups = votes(rest), {}
            for m in rest:
                need = max(1, math.ceil(round(similarity * (len(m) - depth), 6)))
                order = sorted((-n[at, w], at, L._token(w), w) for at, w in enumerate(m) if at >= depth and n[at, w] >= min_docs)
                lead = [x for x in order if x[3] != "<*>"][:1]
                if lead and len(order) >= need:
                    groups.setdefault(frozenset(lead + [x for x in order if x != lead[0]][: need - 1]), set()).add(m)
            new = set()
            for of in [*groups.values(), matching(rest)]:
                if of and len(set().union(*(rest[m] for m in of))) >= min_docs:
                    new |= matching(of) if of in groups.values() else of
            if not new:
                break
            gone |= new
            rest = {m: h for m, h in rest.items() if m not in new}
    return gone


def test_same_as_a_plain_tree_in_one_task_or_by_joins(spark, monkeypatch):
    texts = _lines(1)
    gone = plain(texts, 5)
    want = [sum(tuple("<*>" if any(c.isdigit() for c in w) else w for w in x.split()) in gone for x in t.split("\n")) for t in texts]
    assert 0 < sum(want) < sum(len(t.split("\n")) for t in texts)
    local = _run(docs(spark, _rows(texts)), min_docs=5)
    assert [local[i][1] for i in range(len(texts))] == want
    # leaves of more lines, or of more tokens, than one task may hold
    for bound, most in (("LEAF_LINES", 2), ("LEAF_TOKENS", 40)):
        with monkeypatch.context() as m:
            m.setattr(L, bound, most)
            assert _run(docs(spark, _rows(texts)), min_docs=5) == local


def test_copies_inside_a_document_count_once_and_all_go(spark):
    line = "this line is said again"
    got = _run(docs(spark, _rows([f"{line}\nx\n{line}", line, f"\n\n{line}\n"])), min_docs=3)
    assert got == {0: ("x", 2), 1: ("", 1), 2: ("\n\n", 1)}
    assert _run(docs(spark, _rows([f"{line}\n{line}\n{line}"])), min_docs=2)[0][1] == 0


def test_edges(spark):
    out = L.drop_recurring(clashing(docs(spark), "n_dropped", "key", "digest", "numbers", "__key"), min_docs=2).collect()
    assert len(out) == 8
    assert [r["text"] for r in out if r["doc_id"] == 2] == [None]
    # repeated rows are documents: their line recurs
    assert [r["text"] for r in out if r["doc_id"] == 1] == ["", ""]
    assert L.drop_recurring(empty(spark)).count() == 0


def test_addresses_take_little_more_than_splitting_and_hashing():
    rng = random.Random(5)
    texts = ["\n".join(" ".join(f"w{rng.getrandbits(40):x}".translate(LETTERS) for _ in range(50)) for _ in range(20)) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(range(200)), pa.array(texts)], names=["key", "digest", "text"])
    plain = lambda: [[xxhash.xxh32_intdigest(t) for t in line.split()] for text in texts for line in text.split("\n")]
    made = lambda: pa.Table.from_batches(L._addresses(2, 4, 5, 50, 2)(iter([batch])))
    assert made()["tokens"].to_pylist() == [[h - (1 << 31) for h in line] for line in plain()]
    assert cpu(made) < 4 * cpu(plain)


LETTERS = str.maketrans("0123456789", "ghijklmnop")


def cpu(run):
    took = []
    for _ in range(3):
        start = time.process_time()
        run()
        took.append(time.process_time() - start)
    return min(took)
