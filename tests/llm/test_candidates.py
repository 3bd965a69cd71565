"""Joins by signatures and words make no pairs that sizes and sketches exclude."""

import random

from pyspark.sql import functions as F

from tallyfold.llm import line_dedup, ngram_join


def test_sketches_bound_the_difference_of_long_lines(spark):
    rng = random.Random(1)
    sets = []
    for n in (10, 40, 47, 48, 49, 60, 110, 140):
        own = [rng.getrandbits(62) for _ in range(n)]
        sets += [own, own[: n - n // 10] + [rng.getrandbits(62) for _ in range(n // 8)], [rng.getrandbits(62) for _ in range(n)]]
    rows = spark.createDataFrame([(i, s, len(s)) for i, s in enumerate(sets)], "i long, codes array<long>, n int").select("i", "n", *line_dedup.sketches(F.col("codes")))
    both = rows.alias("x").crossJoin(rows.alias("y")).select(F.col("x.i").alias("i"), F.col("y.i").alias("j"), line_dedup._differing("x", "y").alias("bits"), line_dedup._allowed("x", "y").alias("allowed")).collect()
    for r in both:
        a, b = set(sets[r.i]), set(sets[r.j])
        assert r.bits <= len(a ^ b)
        assert r.allowed or 5 * len(a & b) < 4 * len(a | b)
        # unrelated sets of 110 to 140 words differ in more bits than 64 could tell
        if len(a) >= 110 and len(b) >= 110 and not a & b:
            assert not r.allowed


def test_signatures_meet_only_in_close_classes(spark):
    """Short texts around one common passage share signatures, but few of them are close."""
    rng = random.Random(2)
    common = " ".join(f"c{i}" for i in range(12))
    texts = [f"{common} {' '.join(f'w{rng.randrange(10**9)}' for _ in range(4))}" for _ in range(300)]
    join = ngram_join._Join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text", 3, 80)
    made = []
    join.met = lambda groups, met=join.met: made.append(met(groups)) or made[-1]
    join.run()
    pairs = [(set(p.split()), set(q.split())) for p in texts[:40] for q in texts[:40] if p < q]
    assert all(len(p & q) == 12 for p, q in pairs)
    # at most 10 of 14 shingles agree: 71 in 100 of 18, below the threshold of 80
    assert join.links is None or join.links.count() == 0
    assert sum(m.count() for m in made) < 300 * 299 // 2 // 20
    join.kept.drop()


def test_a_pair_that_shares_many_signatures_is_made_once(spark):
    """Texts that differ from each other in somewhat more than they may share most of their segments."""
    rng = random.Random(3)
    common = [f"c{i}" for i in range(112)]
    texts = []
    for _ in range(60):
        own = list(common)
        for at in rng.sample(range(len(own)), 1):
            own[at] = f"w{rng.randrange(10**9)}"
        texts.append(" ".join(own))
    join = ngram_join._Join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text", 3, 90)
    made = []
    join.met = lambda groups, met=join.met: made.append(met(groups)) or made[-1]
    join.run()
    rows = [(r.x.rep, r.y.rep) for m in made for r in m.collect()]
    assert len(rows) > 50 and len(rows) == len(set(rows))
    sets = [ngram_join.shingles_of(t.encode()) for t in texts]
    want = {frozenset((i, j)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and 100 * len(a & b) >= 90 * len(a | b)}
    found = {frozenset((r.a, r.b)) for r in join.links.collect()} if join.links is not None else set()
    assert found <= want
    join.kept.drop()


def test_words_of_a_line_are_coded_once(spark, monkeypatch):
    plans, keep = {}, line_dedup.Tables.keep
    monkeypatch.setattr(line_dedup.Tables, "keep", lambda self, df, kind: plans.setdefault(kind, df._jdf.queryExecution().optimizedPlan().toString()) and keep(self, df, kind))
    docs = spark.createDataFrame([(1, "one two three four\n\n \t\nfive"), (2, " one two  three four \n\t\n"), (3, ""), (4, None)], "doc_id long, text string")
    assert sorted(line_dedup.removed_lines(docs).collect()) == [(2, 0)]
    assert plans["lines"].count("transform(split(lower(") == 1
    assert plans["lines"].count("regexp_replace(") == 1
