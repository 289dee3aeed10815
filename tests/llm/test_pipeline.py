import corpus_pipeline as P

from .helpers import clashing, docs, empty
from .test_near_dup import brute

SF = "/root/testdata/sf0.001"


def test_stages_on_edges(spark):
    for name, f in P.STAGES:
        df = clashing(docs(spark), "score", "found", "slot", "component", "taken", "__row")
        out = f(spark, df, SF)
        assert [c for c in df.columns if c != "slot"] == [c for c in out.columns if c not in ("slot", "shard")], name
        assert len(out.collect()) > 0
        assert f(spark, empty(spark), SF).count() == 0


def test_each_stage_against_a_plain_version(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in base.collect()}
    kept = {r["doc_id"] for r in P.language(spark, base, SF).collect()}
    assert kept == {i for i, t in before.items() if t and any(map(str.isalpha, t))}  # all are in a learned language
    first = {r["doc_id"] for r in P.near_duplicates(spark, base, SF).collect()}
    assert first == {i for i, _, c in brute(sorted(before.items()), 5) if i == c}
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in P.decontamination(spark, base, SF).collect()}
    assert clean == {i for i, t in before.items() if not any(x in " ".join(t.lower().split()) for x in items)}
    mixed = P.mixture(spark, base, SF).collect()
    total = sum(len(t.split()) for t in before.values())
    assert abs(sum(len(r["text"].split()) for r in mixed) - 1.5 * total) < 50
    assert all(r["text"] in before[r["doc_id"]] for r in mixed)


FOREIGN = """Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw
Все люди рождаются свободными и равными в своем достоинстве и правах
Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar
すべての人間は、生まれながらにして自由であり
xq9zkd wqpfj zzxkcv qqwrt bvnmk plkjh vvkq 77 zzpq
Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv
Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια""".split("\n")


def test_the_language_stage_uses_its_model(spark):
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(-1 - i, t, None, "s", len(t)) for i, t in enumerate(FOREIGN)]
    mixed = " ".join(r["text"][:200] for r in base.where("lang in ('en', 'de')").limit(20).collect())
    rows.append((-100, mixed, None, "s", len(mixed)))
    whole = base.unionByName(spark.createDataFrame(rows, base.schema))
    kept = {r["doc_id"] for r in P.language(spark, whole, SF).collect()}
    assert {i for i in kept if i < 0} == {-100}
    letters = {r["doc_id"] for r in base.where("text rlike '[A-Za-zÀ-ÿ]'").collect()}
    assert kept >= letters
    # what is kept follows from what was learned: documents of a language without labels go
    unlabelled = base.where("lang in ('en', 'de')").selectExpr("doc_id", "text", "CASE WHEN lang = 'de' THEN 'de' END AS lang", "source", "n_chars")
    english = {r["doc_id"] for r in unlabelled.where("lang is null").collect()}
    left = {r["doc_id"] for r in P.language(spark, unlabelled, SF).collect()}
    assert len(left & english) < 0.1 * len(english) and len(left - english) > 100


def test_run(spark):
    out = P.run(spark, SF)
    assert out.columns[-2:] == ["slot", "shard"] and out.count() > 0
