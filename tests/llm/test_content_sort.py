"""Exact deduplication against a dictionary of whole texts."""

import hashlib
import random

from quern.llm import content_sort

from .helpers import EDGE, clashing, docs, empty


def plain(rows):
    """What must come out: (id, keep_id, group_size, sha256) of each row, and how many of a class are kept."""
    classes = {}
    for id, text in rows:
        norm = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        classes.setdefault(norm, []).append((-len(text or ""), id is None, id))
    out = []
    for norm, members in classes.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        out += [(m[2], best, len(members), hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(out, key=repr)


def check(df, rows):
    found = content_sort.classes(df).collect()
    assert sorted(((r["id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=repr) == plain(rows)
    kept = {}
    for r in found:
        kept[r["text_sha256"]] = kept.get(r["text_sha256"], 0) + r["kept"]
        assert not r["kept"] or r["id"] == r["keep_id"]
    assert set(kept.values()) <= {1}


def test_edges(spark):
    rows = [(r[0], r[1]) for r in EDGE]
    check(docs(spark), rows)
    check(clashing(docs(spark), "id", "norm", "salt", "n", "row", "head", "h"), rows)
    assert content_sort.classes(empty(spark)).count() == 0


def test_random_texts_with_a_hot_one(spark):
    r = random.Random(3)
    rows = []
    for i in range(600):
        text = r.choice(["x y", "xy", "x\ny ", "\x0bx\x0cy\r"]) if i % 3 == 0 else "a shared beginning of many texts, " * 2 + r.choice("abcdefgh") * r.randint(1, 9) + " " * r.randint(0, 2)
        rows.append((r.choice([i, i, 7, None]), text))
    df = docs(spark, [(i, t, None, None, None) for i, t in rows]).repartition(5)
    check(df, rows)
    # other white space counts
    check(docs(spark, [(1, "a b", None, None, None), (2, "ab", None, None, None)]), [(1, "a b"), (2, "ab")])


def test_keep_first_has_the_columns_of_its_input(spark):
    df = clashing(docs(spark, [(1, "a b", "en", "s", 3), (2, "a  b", "en", "s", 4), (3, "c", None, None, 1)]), "norm", "kept")
    out = content_sort.keep_first(df)
    assert out.columns == df.columns and {r["doc_id"] for r in out.collect()} == {2, 3}


def test_no_python_on_the_way(spark, monkeypatch):
    plans = []
    real = content_sort.stage
    monkeypatch.setattr(content_sort, "stage", lambda df, name: (plans.append(df._jdf.queryExecution().toString()), real(df, name))[1])
    plans.append(content_sort.classes(docs(spark))._jdf.queryExecution().toString())
    assert len(plans) == 4 and not any("Python" in p or "Arrow" in p for p in plans)
    ranged = next(p for p in plans if "rangepartitioning" in p).partition("== Physical Plan ==")[2]
    # one exchange: the window's groups are neighbours in a range
    assert ranged.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in ranged
