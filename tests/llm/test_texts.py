"""Quality rules, personal data, near duplicates and repeats against plain versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from kerbline.llm import neardup, pii, quality, substring
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def filler(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()) + str(rng.randrange(300)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = filler(rng, 200)
    passage = filler(rng, 70)
    rows = [None, "", " \n\t ", "one", "two words", "x" * 30_000, "same same same same " * 40, base, base, base.upper()]
    for k in range(30):
        w = base.split()
        for at in rng.sample(range(200), k // 3):
            w[at] = f"edit{rng.randrange(9)}"
        rows.append(" ".join(w))
    rows += [filler(rng, 60) + "\n" + passage + " " + filler(rng, 10 + k) for k in range(12)]
    rows += [filler(rng, rng.randrange(1, 400)) for _ in range(30)]
    rows += ["Only one line here   " + filler(rng, 30), "naïve café ÀÉ " * 20, "Menu | Home | About | Contact\n" + filler(rng, 60) + ".\n" + filler(rng, 60) + "."]
    return list(enumerate(rows))


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in texts], SCHEMA).repartition(5).cache()


def test_quality_counts(docs, texts):
    got = {r["doc_id"]: r for r in quality.clean(docs.select("doc_id", "text")).drop("text").collect()}
    for i, t in texts:
        r = got[i]
        want = brute.quality(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want
        assert not (r["kept"] and r["base_failed"])


def test_quality_drops_lines_not_prose(spark):
    rng = random.Random(6)
    prose = "\n".join(filler(rng, 12) + "." for _ in range(10))
    rows = [(1, prose), (2, "Home | News | Sport | Contact\n" + prose), (3, "BUY!! NOW!! CHEAP!! STUFF!! " * 20)]
    got = {r["doc_id"]: r for r in quality.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["kept"] and got[1]["clean_text"] == prose
    assert got[2]["kept"] and got[2]["clean_text"] == prose
    assert not got[3]["kept"]
    assert quality.kept_rows(quality.clean(spark.createDataFrame(rows, "doc_id long, text string"))).count() == 2


def test_near_duplicates(docs, texts):
    sets = {i: brute.shingles(t) for i, t in texts}
    want = brute.components(sets)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs).collect()}
    assert {i: r["component"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}


def test_near_duplicates_of_five_words(docs, texts):
    want = brute.components({i: brute.shingles(t, 5) for i, t in texts}, 80)
    kept = {r["doc_id"] for r in neardup.keep_one(docs).select("doc_id").collect()}
    assert kept == {i for i, c in want.items() if i == c}


def test_near_duplicates_at_a_low_threshold(spark):
    rng = random.Random(9)
    rows = []
    for k in range(60):
        w = [f"w{k}x{j}" for j in range(300)]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(w[:rng.randrange(178, 198)] + [f"v{k}x{j}" for j in range(30)]))]
    want = brute.components({i: brute.shingles(t) for i, t in rows}, 55)
    got = {r["doc_id"]: r["component"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), num=55).collect()}
    assert got == want and len(set(want.values())) < 90
    with pytest.raises(ValueError):
        neardup.least_shared(10, 100, neardup.K)


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 3), (7, 3)]
    got = {r["id"]: r["component"] for r in neardup.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}
    assert neardup.components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_repeated_windows(docs, texts):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.removed_words(docs).collect()}
    assert got == brute.repeats(texts)


def test_cover_meets_every_distance():
    for d in range(substring.PERIOD):
        assert any((a - b) % substring.PERIOD == d for a in substring.COVER for b in substring.COVER)


def test_repeated_rows_and_missing_ids(spark):
    text = filler(random.Random(1), 40)
    rows = spark.createDataFrame([(5, text), (5, text), (None, text), (7, text + " more")], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_removed"]) for r in substring.removed_words(rows).collect())
    assert got == [(-1, 40), (5, 0), (5, 0), (7, 40)]
    near = {(r["doc_id"], r["component"]) for r in neardup.near_duplicates(rows).collect()}
    assert near == {(5, 5), (None, None), (7, 5)}


def test_repeats_are_cut_out_of_texts(spark):
    passage, rng = filler(random.Random(2), 30), random.Random(4)
    first, second = filler(rng, 5), filler(rng, 5)
    rows = spark.createDataFrame([(1, f"{first}\n{passage}", "a"), (2, f"{second}\n\n{passage}  end", "b"), (3, None, "c")], "doc_id long, text string, `at sign` string")
    got = {r["doc_id"]: (r["text"], r["at sign"]) for r in substring.without_repeats(rows).collect()}
    assert got == {1: (f"{first}\n{passage}", "a"), 2: (f"{second}\n\nend", "b"), 3: (None, "c")}


PERSONAL = [
    None,
    "",
    "mail a.b+c@example.co.uk, or x@y.z_d@e.f; not @a.b nor a@b",
    "1.2.3.4 1.2.3.256 001.02.3.4.5.6.7.8 1..2.3.4",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 12",
    "call +1 (212) 555-0100. or +49 30 1234567 +1 2 +123456789012345678",
    "é\U0001f600 +1 212 555 0100 \U0001f600a@b.c",
    "1" * 30_000,
    "a" * 30_000 + "@",
    "a.b" * 10_000,
    "+" * 3000 + "1",
]


def test_base_spans(spark):
    rows = spark.createDataFrame(list(enumerate(PERSONAL)), "doc_id long, text string")
    out = pii.spans(rows, pii.Model(None, 1.0)).select("doc_id", pii.listed("__base").alias("b"), pii.listed("__spans").alias("s"))
    for r in out.collect():
        assert r["b"] == r["s"] == ",".join(brute.base_spans(PERSONAL[r["doc_id"]]))


def test_redaction(spark):
    rows = spark.createDataFrame([(1, "é a@b.c and +1 212 555 0100!"), (2, "none"), (3, None)], "doc_id long, text string")
    out = pii.spans(rows, pii.Model(None, 1.0))
    got = {r["doc_id"]: r["r"] for r in out.select("doc_id", pii.redacted(out["text"]).alias("r")).collect()}
    assert got == {1: "é [EMAIL] and [PHONE]!", 2: "none", 3: None}


def test_fitted_trees_score_as_spark_does(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        n = f"{rng.randrange(100, 999)}-{rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"
        rows.append((i, f"call phone +1 {n} now" if i % 2 else f"order no {n} of {i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(docs)
    assert model.trees and 0.5 <= model.threshold <= 1.01
    out = pii.spans(docs, model).select("doc_id", pii.listed("__spans").alias("s")).collect()
    assert all(("phone" in r["s"]) >= (r["doc_id"] % 2 == 1) for r in out)
    text = "GBT\n Tree 0 (weight 1.0):\n If (feature 1 <= 2.5)\n  Predict: -1.0\n Else (feature 1 > 2.5)\n  If (feature 0 <= 1.0)\n   Predict: 0.5\n  Else (feature 0 > 1.0)\n   Predict: 1.0"
    assert pii.parse_trees(text, [1.0]) == [(1.0, (1, 2.5, -1.0, (0, 1.0, 0.5, 1.0)))]


def test_trees_learn_from_every_document(spark):
    few = [(i, f"call +1 212 555 {1000 + i}" if i % 2 else f"order 212-555-{1000 + i}") for i in range(120)]
    # Copies count once.
    few += [(1000 + i, few[1][1]) for i in range(50)]
    few = spark.createDataFrame(few, "doc_id long, text string")
    docs = few.unionByName(spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("no data").alias("text")))
    model = pii.fit(docs)
    assert model.trees and model.threshold <= 1.0
    rows = pii.training_rows(pii.marked(docs)).groupBy("label").agg(F.sum("weight").alias("n")).collect()
    assert {r["label"]: r["n"] for r in rows} == {0.0: 60.0, 1.0: 60.0}
    # Rows marked once give the same spans as texts marked again.
    listed = lambda df: {(r[0], r[1]) for r in df.select("doc_id", pii.listed("__spans")).collect()}
    assert listed(pii.accepted(pii.marked(few), model)) == listed(pii.spans(few, model))


def test_pipeline_learns_personal_data_from_every_document(spark, monkeypatch):
    import corpus_pipeline

    seen, learn = [], pii.learn
    monkeypatch.setattr(pii, "learn", lambda rows, *how: (seen.append(rows.count()), learn(rows, *how))[1])
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("mail a@b.c of "), "id").alias("text"))
    out = corpus_pipeline.personal_data(spark, docs, "")
    assert seen == [30_000] and out.filter("text LIKE 'mail [EMAIL] of %'").count() == 30_000


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert quality.clean(none).count() == 0
    assert neardup.near_duplicates(none).count() == 0
    assert substring.removed_words(none).count() == 0
    assert pii.spans(none, pii.fit(none)).count() == 0


def test_no_words_hash():
    assert brute.repeats([(1, None)])[1] == (0, 0, hashlib.sha256(b"").hexdigest())


def test_near_duplicates_of_ids_with_several_texts(spark):
    rng = random.Random(21)
    rows = []
    for k in range(40):
        for text in (filler(rng, 120), filler(rng, 120)):
            w = text.split()
            w[60] = "changed"
            rows += [(k, text), (1000 + len(rows), " ".join(w))]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in rows], SCHEMA).repartition(5)
    got = neardup.near_duplicates(docs).collect()
    assert sorted(r["component"] for r in got) == sorted(4 * list(range(40)))
    kept = sorted((r["doc_id"], r["text"]) for r in neardup.keep_one(docs).collect())
    assert kept == sorted(r for r in rows if r[0] < 1000)


def test_near_duplicates_of_a_contested_group(spark):
    """500 edits of one text around the threshold, many edits in common."""
    rng = random.Random(22)
    base = [f"w{j}" for j in range(150)]
    rows = []
    for k in range(500):
        w = list(base)
        for _ in range(rng.randrange(2, 14)):
            at = rng.randrange(0, 150, 3)
            w[at] = f"edit{at % 4}"
        rows.append((k, " ".join(w[: rng.randrange(135, 151)])))
    rows += [(600 + k, " ".join(base[k : k + rng.randrange(60, 120)])) for k in range(30)]
    want = brute.components({i: brute.shingles(t) for i, t in rows})
    docs = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in rows], SCHEMA).repartition(7)
    got = {r["doc_id"]: r["component"] for r in neardup.near_duplicates(docs).collect()}
    assert got == want and len(set(want.values())) > 50


def test_rows_that_a_join_needs_pass_the_map(spark):
    asked = [0, -1, 7, 2**63 - 1, -(2**63), *range(1000, 2000, 7)]
    ids = spark.createDataFrame([(i,) for i in asked], "node long").repartition(3)
    df = spark.createDataFrame([(i, str(i)) for i in [None, *asked, *range(10**6, 10**6 + 20_000)]], "id long, text string")
    got = [r["id"] for r in neardup._among(df, "id", ids).collect()]
    assert set(asked) <= set(got) and len(got) < len(asked) + 100
    assert neardup._among(df, "id", ids.limit(0)).count() == 0


def test_sets_move_once_to_their_centres(spark, docs, monkeypatch):
    """Whatever is broadcast or not, other moves are of sets that were asked for (through the map)."""
    moved, settle = [], neardup.settle

    def nodes(plan):
        yield plan
        below = plan.children()
        for at in range(below.size()):
            yield from nodes(below.apply(at))

    def moves_set(node):
        out = node.output()
        return node.nodeName() == "Exchange" and any(out.apply(i).name() in ("set", "sx", "sy") for i in range(out.size()))

    def stored(df):
        plan = df._jdf.queryExecution().executedPlan()
        plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
        moved.extend(n.toString() for n in nodes(plan) if moves_set(n) and "getbit" not in n.toString())
        return settle(df)

    monkeypatch.setattr(neardup, "settle", stored)
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        neardup.near_duplicates(docs).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    # Sets of classes and of centres, and the stored second sides of both last comparisons.
    assert len(moved) == 4


def test_near_duplicates_of_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d", 1, "x", b"y")], "doc_id long, text string, mark int, node string, component binary")
    assert neardup.near_duplicates(docs).first()["component"] == 1
    assert neardup.keep_one(docs).columns == docs.columns and neardup.keep_one(docs).count() == 1
    assert neardup.keep_one(docs.limit(0)).count() == 0 and neardup.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(9 * i % 41, 7 * i % 41 + 41) for i in range(30)] + [(5, 6), (6, 5), (5, 6)]])
def test_components_are_those_of_a_plain_search(spark, links):
    from kerbline.llm.neardup import components

    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    least = {v: v for link in links for v in link}
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert got == {v: m for v, m in least.items() if v != m}
