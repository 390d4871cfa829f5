"""The registered queries and the pipeline against plain Python on whole
tables, and the parts of their methods against exhaustive versions."""

import base64
import hashlib
import html
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_CHECK, SF_SMALL
from oracle_compare import compare
from occurrence_lake.llm import bpe_stream, decontaminate, html_extract, quality, simhash, syncmer, token_count
from occurrence_lake.llm.common import written
from occurrence_lake.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(name, sf=SF_SMALL, columns="*"):
    return duckdb.sql(f"SELECT {columns} FROM read_parquet('{sf}/{name}.parquet') ORDER BY 1").fetchall()


def by_id(df, key):
    out = {r[key]: r for r in df.collect()}
    assert len(out) == df.count()
    return out


# -- SimHash ---------------------------------------------------------------
def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """id -> least id of its component, from all pairs of fingerprints."""
    ids, parent = list(prints), {i: i for i in prints}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def test_simhash_query(spark):
    prints = {i: plain_fingerprint(t) for i, t in rows("documents", columns="doc_id, text")}
    expected = plain_components(prints)
    got = by_id(QUERIES["op2_simhash_near_dedup"](spark, SF_SMALL), "doc_id")
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{prints[i]:016x}", c) for i, c in expected.items()}


@pytest.mark.parametrize("tree_size", [4096, 8])
def test_links_of_crowded_fingerprints(spark, tree_size):
    """Groups of near fingerprints, chains, and shards of many trees."""
    rnd = random.Random(7)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(25):
            values.add(x)
            x ^= sum(1 << rnd.randrange(64) for _ in range(rnd.choice((1, 2, 3, 4))))
    values |= {rnd.getrandbits(64) for _ in range(100)}
    prints = {simhash.signed(v): v for v in values}
    distinct = spark.createDataFrame([(i,) for i in prints], "fp bigint")
    found = {r["node"]: r["root"] for r in simhash.components(simhash.links(distinct, 3, tree_size)).collect()}
    assert {i: found.get(i, i) for i in prints} == plain_components(prints)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.integers(0, 2**64 - 1), st.integers(0, 40))
def test_bk_tree(values, query, radius):
    tree = simhash.BkTree()
    for v in values:
        tree.add(v)
    assert sorted(tree.within(query, radius)) == sorted({v for v in values if (v ^ query).bit_count() <= radius})


def test_components_of_a_long_chain(spark):
    n = 300
    order = random.Random(1).sample(range(n), n)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)], "a bigint, b bigint")
    out = simhash.components(edges).collect()
    assert {r["root"] for r in out} == {0} and len(out) == n - 1


# -- syncmers --------------------------------------------------------------
def plain_hash(*values):
    """XXH64 chained over words (text) or earlier hashes (signed longs)."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True), seed=h)
    return h - 2**64 if h >= 2**63 else h


def plain_anchors(text, k=4, s=2):
    words = [plain_hash(w) for w in re.findall(r"[^ \t\n\x0b\f\r]{1,32}", text)]
    out = []
    for i in range(len(words) - k + 1):
        inner = [plain_hash(*words[i + j:i + j + s]) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i, plain_hash(*words[i:i + k])))
    return out or ([(0, plain_hash(*words))] if words else [])


def plain_print(anchors):
    least = sorted({h for _, h in anchors})[:64]
    every = ",".join(f"{p} {h}" for p, h in anchors)
    return ".".join(f"{h % 2**64:x}" for h in least) + ":" + hashlib.sha256(every.encode()).hexdigest() if anchors else ""


def test_syncmers_equal_a_plain_version_on_the_whole_table(spark):
    docs = sorted(((i, t or "") for i, t in rows("documents", columns="doc_id, text")), reverse=True)
    got = by_id(QUERIES["op3_syncmer_fingerprints"](spark, SF_SMALL), "doc_id")
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        cut = len(text) // 3
        own, new, other = (plain_anchors(t) for t in (text, text[:len(text) - cut] + after[:cut], after))
        assert (got[i]["fingerprint"], got[i]["edited_fingerprint"]) == (plain_print(own), plain_print(new))
        for name, b in (("near_edited", new), ("near_next", other)):
            assert got[i][name] <= plain_likeness(own, b) + 1e-12
            if len({h for _, h in own}) == len(own) and len({h for _, h in b}) == len(b):
                assert got[i][name] == pytest.approx(plain_likeness(own, b), abs=1e-12)
    assert len(got) == len(docs)


@pytest.mark.parametrize("partitions", ["1", "5", "300"])
def test_neighbours_do_not_depend_on_the_ranges(spark, partitions):
    """Ids far apart, a very long text, repeated ids and null ids."""
    ids = [*range(40), 2**61, -(2**61), 7, 7, 7, None, None]
    df = spark.createDataFrame([(i, f"row {n} " + "long " * (30000 if n == 3 else n)) for n, i in enumerate(ids)], "doc_id bigint, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        near = syncmer.with_next(df.withColumn("tie", F.col("text")), "doc_id", ["text"], "tie", "text")
        got = sorted(((r["text"], r["next_text"]) for r in near.collect()))
        nothing = df.where("false").withColumn("tie", F.col("text"))
        assert syncmer.with_next(nothing, "doc_id", ["text"], "tie", "text").count() == 0
        alone = df.where("doc_id is null").withColumn("tie", F.col("text"))
        assert len({r["next_text"] for r in syncmer.with_next(alone, "doc_id", ["text"], "tie", "text").collect()}) == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = [r["text"] for r in sorted(df.collect(), key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["text"]))]
    assert got == sorted(zip(order, order[1:] + order[:1]))


def test_syncmer_query(spark):
    docs = rows("documents", columns="doc_id, text")
    got = by_id(QUERIES["op3_syncmer_fingerprints"](spark, SF_SMALL), "doc_id")
    order = sorted(docs, reverse=True)
    near = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        if len(text) >= 300:
            near.append((got[i]["near_edited"], got[i]["near_next"]))
    assert np.mean([a for a, _ in near]) > 0.4 and np.mean([b for _, b in near]) < 0.05
    assert all(0 <= x <= 1 for pair in near for x in pair)
    prints = defaultdict(set)
    for i, text in docs:
        prints[text].add(got[i]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_anchors_do_not_depend_on_their_surroundings(spark):
    rnd = random.Random(5)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    texts = [(1, " ".join(words[:300])), (2, " ".join(["front", "matter"] * 9 + words[100:]))]
    a, b = (syncmer.anchors(spark.createDataFrame([t], "doc_id bigint, text string")) for t in texts)
    shift = syncmer.aligned(a, b).orderBy("n", ascending=False).first()
    assert shift["shift"] == 18 - 100 and shift["n"] > 60


def plain_likeness(a, b):
    """Best single shift over all pairs of equal anchors, by counting."""
    places = defaultdict(list)
    for pos, h in b:
        places[h].append(pos)
    shifts = defaultdict(int)
    for pos, h in a:
        for at in places[h]:
            shifts[at - pos] += 1
    m = max(shifts.values(), default=0)
    return m / (len(a) + len(b) - m) if a or b else 1.0


def test_likeness_is_that_of_all_aligned_anchors(spark):
    """A short shared passage of long texts, a small edit, another order and
    a text that repeats itself."""
    rnd = random.Random(8)
    new = lambda n: [f"w{rnd.randrange(10**7)}" for _ in range(n)]
    long, shared, parts = new(6000), new(300), [new(400) for _ in range(3)]
    texts = [new(3000) + shared + new(500), new(900) + shared + new(5000), long, long[:3000] + ["other"] + long[3001:],
             sum(parts, []), sum(parts[::-1], []), "again and again it says so ".split() * 900, "again and again it says so ".split() * 900, []]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = by_id(syncmer.neighbour_fingerprints(df), "doc_id")
    anchors = defaultdict(list)
    for r in syncmer.anchors(df).collect():
        anchors[r["doc_id"]].append((r["pos"], r["hash"]))
    for i in range(len(texts)):
        assert got[i]["near_next"] == plain_likeness(anchors[i], anchors[i - 1 if i else len(texts) - 1])
    assert 0 < got[1]["near_next"] < 0.1 and 0.99 < got[3]["near_next"] < 1 and got[5]["near_next"] < 0.5 and got[7]["near_next"] == 1
    assert len({got[i]["fingerprint"] for i in range(len(texts))}) == len(texts) - 1


# -- tokens ----------------------------------------------------------------
def test_token_query(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    got = by_id(QUERIES["op4_token_counts"](spark, SF_SMALL), "doc_id")
    for i, text in rows("documents", columns="doc_id, text"):
        n = len(sp.encode(text or ""))
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((text or "").encode()), n, n > 4096)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab ▁\n\té½<>日　", max_size=30), max_size=4))
def test_cuts_are_safe(texts):
    sp, safe = token_count.load_piece_model(tokenizer_path("piece_bpe_32k.model"))
    assert safe
    assert token_count.count_tokens(texts, sp, True, {}) == [len(sp.encode(t)) for t in texts]


def test_chunk_memory_is_bounded(monkeypatch):
    sp, _ = token_count.load_piece_model(tokenizer_path("piece_bpe_32k.model"))
    monkeypatch.setattr(token_count, "CACHE_CHUNKS", 10)
    known = {}
    texts = [" ".join(f"word{i}" for i in range(k, k + 7)) for k in range(0, 70, 7)]
    for t in texts:
        assert token_count.count_tokens([t], sp, True, known) == [len(sp.encode(t))]
        assert len(known) <= 10


# -- BPE -------------------------------------------------------------------
@pytest.fixture(scope="module")
def bpe():
    return bpe_stream.WordBpe(tokenizer_path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def test_bpe_query(spark, library):
    got = by_id(QUERIES["op8_bpe_stream"](spark, SF_SMALL), "doc_id")
    for i, text in rows("documents", columns="doc_id, text"):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("abeéñß ' .!\x00\x1ćİΣ")), max_size=80))
def test_bpe_any_text(bpe, library, text):
    for t in (text, text + "<|endoftext|>" + text, "<|" + text):
        assert bpe.encode(t) == library.encode(t, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aehlnorst", min_size=1, max_size=400), st.integers(1, 60))
def test_transducer_in_small_blocks(bpe, text, step):
    """A word fed in blocks gives the tokens of the whole word."""
    t = bpe_stream.Transducer(bpe.ranks, bpe.lookahead)
    symbols = bpe.symbols(text * 4)
    tokens = [x for i in range(0, len(symbols), step) for x in t.feed(symbols[i:i + step], i + step >= len(symbols))]
    assert tokens == t.merge(symbols)


def test_a_long_word_needs_constant_memory(bpe, library):
    word = "".join(random.Random(2).choices("aeihlnorst", k=30_000))
    t, held = bpe_stream.Transducer(bpe.ranks, bpe.lookahead), 0
    symbols, tokens = bpe.symbols(word), []
    for i in range(0, len(symbols), 2048):
        tokens += t.feed(symbols[i:i + 2048], i + 2048 >= len(symbols))
        held = max(held, len(t.held))
    assert tokens == library.encode(word, add_special_tokens=False).tokens
    assert held <= bpe.lookahead + 32


def test_incremental_decoding_gives_back_the_words(bpe):
    text = "the café , naïve 日本 🤗 !"
    assert "".join(bpe.decode_text(bpe.encode(text))).split() == text.split()


def test_bpe_digest_decodes_the_ids(library):
    """A wrong id shows in the digest of the decoded text."""
    own = bpe_stream.WordBpe(tokenizer_path("word_bpe_49k.json"))
    text = "a few plain words and <|endoftext|> more"
    ids = library.encode(text, add_special_tokens=False).ids
    good = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert own.digests(text)[2] == good and "".join(own.decode_tokens(ids)) == library.decode(ids, skip_special_tokens=False)
    own.tokens[ids[2]] = own.tokens[ids[3]]
    assert own.digests(text)[2] != good


_CUT_TEXT = st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aabcdelnrstvéñİß''.!-1 \n\t\x85\u3000日本語。ćΣ한가")), max_size=120)


@settings(max_examples=300, deadline=None)
@given(_CUT_TEXT, st.integers(1, 12))
def test_bpe_cut_into_small_blocks(bpe, library, text, size):
    before, bpe_stream.BLOCK_CHARS = bpe_stream.BLOCK_CHARS, size
    try:
        for t in (text, "it'll" + text.replace(" ", "") + "<|endoftext|>" + text * 2, "<|" + text):
            ids = library.encode(t, add_special_tokens=False).ids
            assert "".join(b for b, _ in bpe.blocks(t)) == t and bpe.encode(t) == ids
            decoded = library.decode(ids, skip_special_tokens=False)
            assert bpe.digests(t)[2] == hashlib.sha256(decoded.encode()).hexdigest()
    finally:
        bpe_stream.BLOCK_CHARS = before


def test_bpe_blocks_of_texts_without_spaces(bpe, library):
    for unit in ("line of text\n".replace(" ", "\n"), "path/to,some.thing;", "aeihlnorst", "日本語漢字"):
        text = unit * (300_000 // len(unit))
        assert max(len(b) for b, _ in bpe.blocks(text)) < 1.1 * bpe_stream.BLOCK_CHARS
        assert bpe.encode(text) == library.encode(text, add_special_tokens=False).ids


# -- pages -----------------------------------------------------------------
def test_html_query(spark):
    got = by_id(QUERIES["op6_html_extraction"](spark, SF_SMALL), "page_id")
    for i, url, page in rows("pages"):
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        text = "\n".join(p for p in parts if p)
        assert (got[i]["url"], got[i]["text"], got[i]["n_chars"]) == (url, text, len(text))


def test_warc_query(spark):
    pages = rows("pages", columns="page_id, html")
    last = {}
    for i, page in pages:
        last[page or ""] = max(i, last.get(page or "", i))
    got = by_id(QUERIES["op7_warc_archive"](spark, SF_SMALL), "page_id")
    for i, page in pages:
        raw = (page or "").encode()
        kind = ("response", None) if last[page or ""] == i else ("revisit", last[page or ""])
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (got[i]["record_type"], got[i]["refers_to"]) == kind


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="<>/!-\"'= apbdivscrt&;\n", max_size=200))
def test_html_never_fails(page):
    assert isinstance(html_extract.main_text(page, None), str)


# -- quality ---------------------------------------------------------------
def test_quality_on_held_out_labels(spark):
    """Gold labels are only read here."""
    gold = dict(rows("labels", SF_CHECK, "doc_id, quality"))
    got = by_id(QUERIES["op10_quality_classifier"](spark, SF_CHECK), "doc_id")
    good = [got[i]["keep"] for i, q in gold.items() if q == 1]
    bad = [got[i]["keep"] for i, q in gold.items() if q == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.05


def test_label_model_finds_a_poor_labeller():
    rnd = np.random.default_rng(3)
    k = len(quality.LABELLERS)
    truth = rnd.random(4000) < 0.7
    votes = np.where(rnd.random((4000, k)) < 0.85, truth[:, None], ~truth[:, None]).astype(int)
    votes[:, 0] = rnd.integers(0, 2, 4000)
    codes, counts = np.unique(votes @ 3 ** np.arange(k - 1, -1, -1), return_counts=True)
    posterior, tables, prior = quality.label_model(dict(zip(codes.tolist(), counts.tolist())))
    assert abs(prior - 0.7) < 0.03
    assert abs(tables[0, 1, 1] - 0.5) < 0.05 and (np.abs(tables[1:, 1, 1] - 0.85) < 0.05).all()


# -- SQL twins and the pipeline ---------------------------------------------
def test_queries_match_their_sql(spark):
    res = compare(spark, SF_SMALL, list(ORACLE_SQL), verbose=False)
    assert not {k: v for k, v in res.items() if v.get("ok") is not True}


def test_short_items_and_straddling_windows(spark):
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(6)]
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    docs = [(i, text(rnd.choice((0, 3, 12, 13, 40, 200)))) for i in range(40)]
    items = [(i, text(n)) for i, n in enumerate((1, 4, 7, 12, 12))]
    items += [(100 + i, " ".join(docs[i][1].split()[k:k + n])) for i in range(40) for k, n in ((0, 13), (5, 20))]
    got = by_id(decontaminate.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")), "doc_id")
    for i, doc in docs:
        words, hit, found = doc.split(), set(), set()
        for item, t in items:
            own = t.split()
            n = min(13, len(own))
            for s in range(len(words) - n + 1):
                if n and any(own[k:k + n] == words[s:s + n] for k in range(len(own) - n + 1)):
                    hit.update(range(s, s + n))
                    found.add(str(item))
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"], got[i]["items_sha256"]) == (
            len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())


def test_pipeline(spark):
    """Each stage against its own input; the last against the library."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "simhash near-dedup", "benchmark decontamination", "bpe encoding and decoding"]
    (_, classify), (_, dedupe), (_, clean), (_, encode) = corpus_pipeline.STAGES
    judged = written(classify(spark, docs, SF_SMALL), "t1")
    gold = dict(rows("labels", columns="doc_id, quality"))
    left = {r["doc_id"] for r in judged.collect()}
    assert judged.columns == columns and np.mean([i in left for i, q in gold.items() if q]) >= 0.98 and not any(i in left for i, q in gold.items() if not q)
    once = written(dedupe(spark, judged, SF_SMALL), "t2")
    expected = plain_components({r["doc_id"]: plain_fingerprint(r["text"]) for r in judged.collect()})
    assert once.columns == columns and sorted(r["doc_id"] for r in once.collect()) == sorted(set(expected.values()))
    pure = written(clean(spark, once, SF_SMALL), "t3")
    texts = {r["doc_id"]: r["text"] for r in once.collect()}
    windows = set()
    for _, t in rows("benchmark"):
        w = WORD.findall(t.translate(LOWER))
        windows |= {tuple(w[k:k + 13]) for k in range(len(w) - 12)}
    kept = set()
    for i, t in texts.items():
        w = WORD.findall(t.translate(LOWER))
        hit = {p for s in range(len(w) - 12) if tuple(w[s:s + 13]) in windows for p in range(s, s + 13)}
        if not hit or 20 * len(hit) < len(w):
            kept.add(i)
    assert pure.columns == columns and {r["doc_id"] for r in pure.collect()} == kept
    result = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, encode(spark, pure, SF_SMALL).collect()))


def test_bpe_cuts_runs_of_any_kind(monkeypatch):
    """Runs without white space are cut in blocks of the stated size, and
    the ids stay the library's."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    bpe, library = bpe_stream.WordBpe(path), Tokenizer.from_file(path)
    for unit in ("!", "\U0001f642", "\u0928\u093f", "7", "'", "\u03b1\u03b2\u03b3", "a", "#$%"):
        assert max(len(b) for b, _ in bpe.blocks(unit * (300_000 // len(unit)))) <= 1.1 * bpe_stream.BLOCK_CHARS
    monkeypatch.setattr(bpe_stream, "BLOCK_CHARS", 8)
    rnd = random.Random(4)
    kinds = ["'s!lt\u2019", "78a!", "\U0001f642!'s<|", "\u03a3\u03c3\u03c2a'", "\u0928\u093f\u093c\u094d\u0915", "\u0e01\u0e34\u0e48", "\u0995\u09be\u09c7\u09d7",
             "".join(map(chr, range(33, 127))), "\u05d0\u05b0\u0627\u064b", "\u3001\u3042\uff01\u4e2d\u2190\u25a0"]
    for i in range(6000):
        text = "".join(rnd.choices(kinds[i % len(kinds)], k=rnd.randrange(1, 60)))
        text = text if i % 5 else text + "<|startoftext|>" + text
        assert bpe.encode(text) == library.encode(text, add_special_tokens=False).ids, text
