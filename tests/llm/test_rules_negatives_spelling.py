"""Quality rules, hard negatives and spelling variants: against plain Python,
and with nulls, empties, ties, repeated rows, long texts and clashing names."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from occurrence_lake.llm import hard_negatives, rule_cascade, spelling
from occurrence_lake.llm.queries import QUERIES
from test_small_cases import CLASHES, LONG, ROWS, docs

WORD = re.compile("[^\x20\x09-\x0d]+")


# -- quality rules -----------------------------------------------------------
def plain_facts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def facts_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    made = rule_cascade.judged(rows, rule_cascade.RULES[:1], facts=names).collect()
    return {r["doc_id"]: tuple(r["judged"][n] for n in names) for r in made}


def test_facts(spark):
    unit = "a b c d e f g h "
    texts = [None, "", " \t\n", "one", unit, unit * 2, unit + "x " + unit, unit + unit[:-2], "a a a a a a a a a", "l\n\nl\n \nl\nm #\n#\n#",
             "x y z \U0001f600 é", LONG, ("p q r s t u v w x y\n" * 3), "l\r\nl\r\nl", unit * 3 + "end " + unit.upper() + unit]
    got = facts_of(spark, texts)
    assert got == {i: plain_facts(t) for i, t in enumerate(texts)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "é", "#", "\n"]), max_size=60), min_size=1, max_size=25))
def test_facts_of_few_words_repeated(spark, texts):
    texts = [" ".join(t) for t in texts]
    assert facts_of(spark, texts) == {i: plain_facts(t) for i, t in enumerate(texts)}


def test_order_by_rejection_per_cost():
    # rule 1 rejects most but is dear; rule 2 rejects only what rule 0 has rejected
    patterns = {(True, True, True): 40, (False, True, False): 30, (False, False, False): 30}
    assert rule_cascade.by_rejection_per_cost(patterns, [1.0, 10.0, 1.0])[0] == 0
    assert rule_cascade.by_rejection_per_cost(patterns, [1.0, 10.0, 1.0]) == [0, 1, 2]
    assert rule_cascade.by_rejection_per_cost(patterns, [1.0, 1.0, 1.0])[0] == 1


def test_cascade_stops_at_the_first_rejection(spark):
    """Rules behind a rejecting one are not evaluated."""
    fails = rule_cascade.Rule("never", lambda f: F.raise_error(F.lit("reached")).cast("boolean"))
    always = rule_cascade.Rule("always", lambda f: f("n_words") >= 0)
    df = spark.createDataFrame([("a b",)], "text string")
    facts = rule_cascade.fact_columns(F.col("text"), rule_cascade.words_of(F.col("text")))
    assert df.select(rule_cascade.first_rejecting([always, fails], facts).alias("r")).first()["r"] == "always"
    with pytest.raises(Exception, match="reached"):
        df.select(rule_cascade.first_rejecting([fails, always], facts).alias("r")).collect()


def test_kept_does_not_depend_on_the_order(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    words = rule_cascade.words_of(F.col("text"))
    facts = rule_cascade.fact_columns(F.col("text"), words)
    one = rule_cascade.first_rejecting(rule_cascade.RULES, facts).isNull()
    two = rule_cascade.first_rejecting(rule_cascade.RULES[::-1], facts).isNull()
    ids = {r["doc_id"] for r in df.where(one).collect()}
    assert ids == {r["doc_id"] for r in df.where(two).collect()} == {r["doc_id"] for r in rule_cascade.kept_rows(df).collect()}
    assert ids == {r["doc_id"] for r in QUERIES["op11_quality_rules"](spark, SF_SMALL).where("kept").collect()}
    good = duckdb.sql(f"SELECT doc_id FROM read_parquet('{SF_SMALL}/labels.parquet') l JOIN read_parquet('{SF_SMALL}/documents.parquet') d USING (doc_id) "
                      "WHERE quality = 1 AND len(regexp_extract_all(text, '[^ \\n]+')) >= 20").fetchall()
    assert np.mean([i in ids for i, in good]) >= 0.95


def test_rules_small_cases(spark):
    rows, none = docs(spark, ROWS), docs(spark, [])
    out = rule_cascade.judged(rows, rule_cascade.RULES[:3])
    assert out.count() == len(ROWS) and out.columns == [*rows.columns, "judged"]
    assert {r["judged"]["rejected_by"] for r in out.where("doc_id < 4").collect()} == {"few words"}
    assert rule_cascade.kept_rows(rows, rule_cascade.RULES[:1]).columns == rows.columns and rule_cascade.kept_rows(none).count() == 0
    assert rule_cascade.judged(none).count() == 0


# -- hard negatives ----------------------------------------------------------
def plain_negatives(rows, every, positives=5, negatives=10, low=30, high=90):
    """{(anchor, positive, rank): (negative, scores)} from all pairs, in Python integers."""
    rows = {i: (label, [int(np.floor(256 * np.float64(x))) for x in v]) for i, label, v in rows}
    out = {}
    for a in rows:
        if a % every:
            continue
        label, q = rows[a]
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, l == label) for i, (l, v) in rows.items() if i != a)
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            fit = [(i, -t) for t, i, same in scored if not same and low * -s <= 100 * -t <= high * -s][:negatives]
            out.update({(a, p, rank): (i, -s, t) for rank, (i, t) in enumerate(fit, 1)})
    return out


def mined(df, every):
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % every == 0).collect()
    out = {(r["anchor_id"], r["positive_id"], r["rank"]): (r["negative_id"], r["positive_score"], r["negative_score"]) for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("scale, noise", [(1.0, 0.05), (1.0, 1.0), (1e5, 0.3), (1e-3, 0.1)])
def test_negatives_of_near_vectors(spark, monkeypatch, scale, noise):
    """Vectors around a few centres (coordinate ranges prune), of many
    lengths, with ties, zeros and products beyond exact doubles."""
    monkeypatch.setattr(hard_negatives, "SEED_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 64)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 4)
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(6, 12))
    rows = []
    for i in range(420):
        v = (centres[i % 6] + noise * rnd.normal(size=12)) * rnd.choice([0.2, 1, 1, 5]) * scale
        rows.append((i, int(rnd.integers(3)), [float(x) for x in (v if i % 50 else v * 0)]))
    rows += [(1000 + i, r[1], r[2]) for i, r in enumerate(rows[:40])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    expected = plain_negatives(rows, 10)
    assert expected and mined(df, 10) == expected


def test_pruned_candidates_keep_every_score_in_reach():
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(4, 8)) * 300
    x = np.floor(centres[rnd.integers(4, size=300)] + rnd.normal(size=(300, 8)) * 20).astype(np.int64)
    block = hard_negatives.Block(np.arange(300), np.zeros(300, np.int64), x)
    queries = x[:40]
    scores = x @ queries.T
    low, high = np.full(40, 0.8) * scores.max(0), np.full(40, 0.97) * scores.max(0)
    answered, pruned = set(), 0
    for q, rows, found in block.candidates(queries, low, high):
        assert (found == scores[rows, q]).all()
        wanted = np.flatnonzero((scores[:, q] >= low[q]) & (scores[:, q] <= high[q]))
        assert set(wanted) <= set(rows.tolist())
        answered.add(q)
        pruned += len(rows) < 150
    assert pruned >= 10 and {q for q in range(40) if ((scores[:, q] >= low[q]) & (scores[:, q] <= high[q])).any()} <= answered


@pytest.mark.parametrize("labels", [2, 60])
def test_negatives_in_lanes_and_waves(spark, monkeypatch, labels):
    """More blocks than lanes, more lanes than a wave, blocks of one label
    and of many, and one vector that many rows have."""
    for name, value in {"SEED_ROWS": 8, "BLOCK_ROWS": 16, "ANCHOR_ROWS": 8, "LANE_VALUES": 512, "LANES": 6, "WAVE": 2, "SPLIT": 2}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rnd = np.random.default_rng(11)
    vectors = rnd.normal(size=(300, 8))
    vectors[rnd.random(300) < 0.2] = vectors[0]
    rows = [(i, int(rnd.integers(labels)), [float(x) for x in v / np.linalg.norm(v)]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    rows = [(i, label, [float(np.float32(x)) for x in v]) for i, label, v in rows]
    expected = plain_negatives(rows, 10)
    assert expected and mined(df, 10) == expected


def test_a_lane_hands_on_few_rows():
    """Vectors of no direction: bounds rise with the rows found, so that most
    pairs of a lane are only multiplied."""
    rnd = np.random.default_rng(13)
    unit = rnd.normal(size=(12_100, 32))
    x = np.floor(256 * unit / np.linalg.norm(unit, axis=1)[:, None]).astype(np.int16)
    anchors = hard_negatives.Rows(np.arange(100), np.zeros(100, np.int64), x[:100])
    goals = np.array([(i, -(2**62), 20_000 - 500 * k) for i in range(100) for k in range(2)])
    best, handed = hard_negatives.Best(anchors, goals, 10), []
    for start in range(100, 12_100, 3000):
        block = hard_negatives.Block(np.arange(start, start + 3000), np.ones(3000, np.int64), x[start:start + 3000])
        handed.append(0)
        for queries, rows, scores in block.hits(anchors, best.which, best.low, best.high, False):
            handed[-1] += len(queries)
            best.add(queries, block.ids[rows], scores)
    goal, ids, scores = best.best()
    every = x[100:].astype(int) @ x[:100].T.astype(int)
    for g, (a, _, most) in enumerate(goals.tolist()):
        fit = sorted((-t, i + 100) for i, t in enumerate(every[:, a].tolist()) if t <= most)[:10]
        assert [(-t, i) for t, i in zip(scores[goal == g].tolist(), ids[goal == g].tolist())] == fit
    assert handed[-1] < 3000 * 100 * 0.02


def test_negatives_small_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 2, [0.5, 0.0]), (3, 2, [0.5, 0.0]), (3, 2, [0.5, 0.0]), (4, None, [0.5, 0.0]), (5, 2, None),
            (6, 2, [nan, 0.5]), (7, 2, [inf, 0.0]), (8, 2, [0.5, None]), (None, 2, [0.5, 0.0]), (9, 2, [0.4]), (11, 2, []), (12, 2, [1e30, 0.0]), (13, 3, [0.5, 0.0, 7.0])]
    frame = lambda r: spark.createDataFrame(r, "vec_id bigint, label int, embedding array<double>").select("*", *[F.lit(1).alias(c) for c in (*CLASHES, "q", "bucket", "anchor", "score", "rank", "found")])
    assert mined(frame(rows), 100) == {(0, 1, k): (i, 65536, s) for k, (i, s) in enumerate([(2, 32768), (3, 32768), (13, 32768), (9, 26112)], 1)}
    assert mined(frame([]), 100) == {} and mined(frame(rows[1:]), 100) == {}
    assert mined(frame([(0, 1, [1.0])]), 1) == {}
    assert hard_negatives.hard_negatives(frame([]), F.col("vec_id") % 10 == 0).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


# -- spelling variants -------------------------------------------------------
def plain_words(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(n, ratio=10):
    # words that are near agree in one half, whole or moved by one letter
    shards = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            shards[w[:k] + "*" + w[k + 1:]].add(w)
            shards[w[:k] + "+" + w[k:]].add(w)
            shards[w[:k] + "+" + w[k + 1:]].add(w)
        shards[w + "+"].add(w)
    near = {w: set() for w in n}
    for group in shards.values():
        for w in group:
            near[w] |= {x for x in group if one_edit(w, x)}
    form = {}
    for w in n:
        top = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = top if top is not None and n[top] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def grouped(df):
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}
    assert len(out) == df.count()
    return out


def test_spelling_query(spark):
    expected = plain_variants(plain_words(duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{SF_SMALL}/documents.parquet')").fetchall()))
    assert grouped(QUERIES["op13_spelling_variants"](spark, SF_SMALL)) == expected
    assert sum(v[3] > 0 for v in expected.values()) > 100


@pytest.mark.parametrize("cell, leaf, sample", [(1 << 18, 128, 1 << 16), (64, 4, 40), (24, 1, 8)])
def test_variants_in_many_cells(spark, monkeypatch, cell, leaf, sample):
    """Crowded letters, anagrams and chains of forms; small cells and a poor
    sample, so that cells overflow into parts."""
    monkeypatch.setattr(spelling, "CELL_LETTERS", cell)
    monkeypatch.setattr(spelling, "LEAF_WORDS", leaf)
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", sample)
    rnd = np.random.default_rng(11)
    words = {"".join(rnd.choice(list("abé"), size=int(rnd.integers(1, 7)))) for _ in range(500)}
    words |= {"x" * k for k in range(1, 12)} | {"y" * 5000, "y" * 5001, "y" * 2500 + "z" + "y" * 2500}
    n = {w: int(10 ** rnd.integers(0, 5)) for w in sorted(words)}
    n |= {"x" * k: 10 ** k for k in range(1, 12)}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint")
    assert grouped(spelling.variants(df)) == plain_variants(n)


def test_spelling_small_cases(spark):
    rows, none = docs(spark, ROWS), docs(spark, [])
    words = {r["word"]: r["n"] for r in spelling.word_counts(rows, least_letters=4, least_count=1).collect()}
    assert words == {"some": 60000, "words": 60000, "very": 60000, "long": 60000, "text": 60000, "here": 1}
    assert grouped(spelling.variants(spelling.word_counts(none))) == {}
    assert grouped(spelling.variants(spelling.word_counts(rows, least_count=10**9))) == {}
    mixed = docs(spark, [(1, "ÀBCdefÿ ÀBCdefÿ÷× Straße1straßeStraße Ελληνικά")])
    assert {r["word"] for r in spelling.word_counts(mixed, least_letters=6, least_count=1).collect()} == {"Àbcdefÿ", "Àbcdefÿ÷×", "straße", "straßestraße"}
    with pytest.raises(ValueError):
        spelling.variants(none.select(F.col("text").alias("word"), F.col("doc_id").alias("n")), ratio=1)


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=8), st.text("abc", min_size=1, max_size=8))
def test_edit_checks(a, b):
    if len(a) == len(b):
        assert bool(spelling.one_replaced(spelling.letters([a]), spelling.letters([b]))[0]) == (one_edit(a, b) and b < a)
    elif len(a) + 1 == len(b):
        assert bool(spelling.one_inserted(spelling.letters([a]), spelling.letters([b]))[0]) == one_edit(a, b)
