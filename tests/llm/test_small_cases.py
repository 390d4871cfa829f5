"""Nulls, empty and long texts, ties, repeated rows, empty tables and
clashing column names, operator by operator."""

import hashlib

import pytest
from pyspark.sql import functions as F

from occurrence_lake.llm import bpe_stream, decontaminate, html_extract, license_scan, quality, simhash, syncmer, token_count, url_filter, warc
from occurrence_lake.llm.queries import BASE_RULES, license_templates, tokenizer_path

LONG = "some words of a very long text " * 20_000
CLASHES = ("id", "fp", "th", "host", "path", "subject", "keep", "quality", "tokens", "record", "digest", "prints", "range", "bucket", "places", "_kid", "words")


def docs(spark, rows, text="text", key="doc_id"):
    made = spark.createDataFrame(rows, f"{key} bigint, {text} string")
    return made.select("*", *[F.lit(1).alias(c) for c in CLASHES])


ROWS = [(1, None), (2, ""), (3, "one"), (4, LONG), (5, LONG), (5, LONG), (None, "no id here at all"), (None, None)]


def got(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def rows(spark):
    return docs(spark, ROWS)


@pytest.fixture(scope="module")
def none(spark):
    return docs(spark, [])


def test_url_filter(spark):
    rules = [url_filter.domain_rule(t, a) for t, a in BASE_RULES] + [url_filter.Rule("spam", "||spam.", "block", 1), url_filter.Rule("*x*y", "*x*y", "block", 1)]
    urls = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.COM/x"), (4, "http://A.COM/x"), (5, "http://com"), (6, "://WWW.example.com/en/?q"),
            (7, "http://b.example.com/en/1"), (8, "http://a?b.com/"), (9, "http://spam.org/" + "y" * 100_000), (10, "http://z.org/x/Y?y#f"), (None, "http://n.net/fr/")]
    pages = spark.createDataFrame(urls, "page_id bigint, url string").select("*", *[F.lit(1).alias(c) for c in CLASHES])
    out = {r["page_id"]: r for r in url_filter.judge_urls(pages, rules).collect()}
    judged = {k: (r["host"], r["path"][:5], r["rule"], r["verdict"]) for k, r in out.items()}
    assert judged == {
        1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("a.com", "/x", "com/", "allow"),
        5: ("com", "", None, "allow"), 6: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        7: ("b.example.com", "/en/1", "example.com/en/", "block"), 8: ("a", "", None, "allow"), 9: ("spam.org", "/yyyy", "spam", "block"),
        10: ("z.org", "/x/Y", "*x*y", "block"), None: ("n.net", "/fr/", "net/fr/", "block")}
    assert url_filter.judge_urls(pages, rules).count() == len(urls)
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(pages, []).collect()} == {"allow"}


def test_url_index_takes_the_rarest_whole_token():
    rule = url_filter.Rule("r", "||ads.example.com/banner*img^", "block")
    assert rule.tokens() == ["ads", "example", "com"]
    index, always = url_filter.build_index([rule, url_filter.Rule("a", "*", "block")], {"ads": 5, "example": 9, "com": 99, "img": 7})
    assert index == {"ads": [0]} and always == [1]


def test_simhash(spark, rows, none):
    out = simhash.near_duplicates(rows)
    assert out.count() == len(ROWS)
    by = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in out.collect()}
    assert by[(1, "0" * 16)] == by[(2, "0" * 16)] == by[(None, "0" * 16)] == 1
    assert {v for (i, _), v in by.items() if i in (4, 5)} == {4}
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.one_of_each(rows)
    assert kept.columns == rows.columns
    assert got(kept, "doc_id", F.length("text")) == sorted([(1, None), (3, 3), (4, len(LONG)), (None, 17)], key=repr)
    assert simhash.one_of_each(none).columns == none.columns


def test_syncmer(spark, rows, none):
    out = syncmer.neighbour_fingerprints(rows).collect()
    assert len(out) == len(ROWS)
    for r in out:
        if r["doc_id"] in (1, 2):
            assert (r["n_chars"], r["fingerprint"], r["near_edited"]) == (0, "", 1.0)
            assert r["edited_sha256"] == hashlib.sha256(b"").hexdigest()
    assert {r["fingerprint"] for r in out if r["doc_id"] in (4, 5)} == {next(r["fingerprint"] for r in out if r["doc_id"] == 4)}
    assert syncmer.neighbour_fingerprints(none).count() == 0
    assert syncmer.neighbour_fingerprints(docs(spark, [(7, "alone here")])).first()["near_next"] == 1.0


def test_token_counts(rows, none):
    path = tokenizer_path("piece_bpe_32k.model")
    out = token_count.token_counts(rows, path)
    assert got(out.where("doc_id < 4"), "doc_id", "n_bytes", "n_tokens", "over_limit")[:2] == [(1, 0, 0, False), (2, 0, 0, False)]
    assert out.where("over_limit").count() == 3 and out.count() == len(ROWS)
    assert token_count.token_counts(none, path).count() == 0


def test_decontamination(spark, rows, none):
    bench = spark.createDataFrame([(7, LONG[:200]), (7, LONG[:200]), (8, None), (9, ""), (None, LONG[:300]), (10, "one"), (11, "no id")], "item_id bigint, text string")
    bench = bench.select("*", F.lit(1).alias("item"), F.lit(2).alias("hash"), F.lit(2).alias("id"))
    out = {(r["doc_id"], r["n_words"]): r for r in decontaminate.contamination(rows, bench).collect()}
    n = len(LONG.split())
    assert out[(1, 0)]["contaminated"] is False and out[(None, 0)]["n_hit"] == 0
    assert out[(3, 1)]["contaminated"] and out[(3, 1)]["items_sha256"] == hashlib.sha256(b"10").hexdigest()
    assert out[(4, n)]["n_hit"] == out[(5, n)]["n_hit"] == n and out[(4, n)]["n_items"] == 1
    assert (out[(None, 5)]["n_hit"], out[(None, 5)]["n_items"]) == (2, 1)
    assert decontaminate.contamination(rows, bench).count() == len(ROWS)
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(rows, bench.limit(0)).where("contaminated").count() == 0
    kept = decontaminate.decontaminated(rows, bench)
    assert kept.columns == rows.columns and got(kept, "doc_id") == [(1,), (2,), (None,)]


def test_html(spark):
    page = ('<!DOCTYPE html><head><title>T</title><script>var a="</p>";</script></head><body><nav><p>Menu</p></nav><div class="cookie-notice">We use</div>'
            '<article class="post12"><h1>Head &amp; line</h1><p><b>One<br>\n two<br><p>Th&eacute;re&nbsp;x</p><form><p>Ask</p></form><div id="comments"><p>First!</p></div>'
            '<ul><li>a<li>b</ul>tail</article><aside>Side</aside><footer>Foot</footer>')
    text = "Head & line\nOne two\nThére x\na\nb\ntail"
    urls = [(1, "http://h.com/a", page), (1, "http://h.com/a", page), (2, None, page), (3, "http://h.com/b", None), (4, "http://h.com/c", ""),
            (5, "http://h.com/d", "<p>" + "word " * 100_000), (6, "http://h.com/e", "plain < text & more"), (None, "x", "<!-- never closed")]
    pages = spark.createDataFrame(urls, "page_id bigint, url string, html string").select("*", *[F.lit(1).alias(c) for c in (*CLASHES, "consensus", "score")])
    out = [(r["page_id"], r["text"], r["n_chars"]) for r in html_extract.extract_pages(pages).collect()]
    assert sorted(out, key=repr) == sorted([(1, text, len(text)), (1, text, len(text)), (2, text, len(text)), (3, "", 0), (4, "", 0),
                                            (5, ("word " * 100_000).strip(), 499_999), (6, "plain < text & more", 19), (None, "", 0)], key=repr)
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_host_votes_outweigh_a_page_of_its_own(spark):
    usual = '<div class="box1"><p>{}</p></div><div class="junk"><p>short words</p></div>'
    odd = '<div class="box2"><p>tiny text</p></div><div class="junk"><p>very many words of boiler plate that outweigh the text</p></div>'
    urls = [(i, "http://h.com/a", usual.format("long text of the page itself " * 3)) for i in range(5)] + [(9, "http://h.com/b", odd)]
    pages = spark.createDataFrame(urls, "page_id bigint, url string, html string")
    assert html_extract.extract_pages(pages).where("page_id = 9").first()["text"] == "tiny text"


def words(n, start="word"):
    """``n`` characters of text."""
    return (f"{start} " + "text " * n)[:n - 1] + "."


@pytest.mark.parametrize("page, kept", [
    ('<div class="content"><div class="left"><p>{}</p></div><div class="right"><p>{}</p></div></div>', (500, 500)),
    ('<div class="content"><p>{}</p><div class="body"><p>{}</p></div></div>', (400, 1000)),
    ('<div class="a"><p>{}</p></div><div class="b"><p>{}</p></div>', (600, 400)),
    ('<div class="content"><h1>{}</h1><div class="body"><p>{}</p></div></div>', (20, 1000)),
    ('<section class="overflow-hidden"><p>{}</p></section><article aria-hidden="false"><p>{}</p></article>', (300, 200)),
    ('<div class="no-sidebar"><p>{}</p></div><div data-role="footer" class="related-party-note"><p>{}</p></div>', (300, 200)),
    ('<article class="post"><p>{}</p></article><article class="featured"><p>{}</p></article>', (300, 200)),
])
def test_html_without_article_is_whole(spark, page, kept):
    """Two parts of a page that are both main text stay, alone and by the
    votes of a host of such pages."""
    parts = [words(n, f"part{i}") for i, n in enumerate(kept)]
    text = "\n".join(parts)
    assert html_extract.main_text(page.format(*parts), None) == text
    pages = spark.createDataFrame([(i, "http://h.com/a", page.format(*parts)) for i in range(3)], "page_id bigint, url string, html string")
    assert [r["text"] for r in html_extract.extract_pages(pages).collect()] == [text] * 3


def test_html_hidden_and_boilerplate_by_whole_names():
    page = ('<div class="box"><p>{0}</p></div><div hidden><p>a {0}</p></div><div aria-hidden="true"><p>b {0}</p></div>'
            '<div class="wide sidebar"><p>c {0}</p></div><div id="cookie-notice"><p>d {0}</p></div><div role="navigation"><p>e {0}</p></div>')
    assert html_extract.main_text(page.format(words(200)), None) == words(200)


def test_html_text_that_only_one_page_of_a_host_has(spark):
    """The host's other pages have no lead; what they all leave out goes."""
    usual = '<div class="content"><div class="body"><p>{}</p></div></div><div class="note"><p>Printed on paper</p></div>'
    other = '<div class="content"><div class="lead"><p>{}</p></div><div class="body"><p>{}</p></div></div><div class="note"><p>Printed on paper</p></div>'
    rows = [(i, "http://h.com/a", usual.format(words(900))) for i in range(4)] + [(9, "http://h.com/b", other.format(words(400, "lead"), words(1000)))]
    out = {r["page_id"]: r["text"] for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert out == {**{i: words(900) for i in range(4)}, 9: words(400, "lead") + "\n" + words(1000)}


def test_warc(spark):
    rows = [(1, "u", "same"), (3, "u\r\nx: y", "same"), (3, "w", "same"), (2, None, "same"), (4, "v", None), (5, "v", ""), (6, "é", "ünï" * 200_000), (None, "n", "same"), (None, "m", "own")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").select("*", *[F.lit(1).alias(c) for c in (*CLASHES, "sha1", "deflated", "revisit")])
    path = warc.new_archive_path(spark)
    warc.write_archive(pages, path)
    out = {(r["id"], r["url"]): r for r in warc.read_records(warc.reconstruct(spark, path)).collect()}
    kinds = {k[0:2]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for k, r in out.items()}
    assert kinds == {(1, "u"): ("revisit", 3, 4), (3, "u%0D%0Ax: y"): ("response", None, 4), (3, "w"): ("response", None, 4), (2, None): ("revisit", 3, 4),
                     (4, "v"): ("revisit", 5, 0), (5, "v"): ("response", None, 0), (6, "é"): ("response", None, 1_000_000),
                     (None, "n"): ("revisit", 3, 4), (None, "m"): ("response", None, 3)}
    assert bytes(out[(6, "é")]["payload"]).decode() == "ünï" * 200_000
    assert spark.read.parquet(path + "/payloads").count() == 4
    empty = warc.new_archive_path(spark)
    warc.write_archive(pages.limit(0), empty)
    assert warc.reconstruct(spark, empty).count() == 0
    small = warc.new_archive_path(spark)
    warc.write_archive(pages, small, min_bytes=5)
    assert warc.read_records(warc.reconstruct(spark, small)).where("record_type = 'revisit'").count() == 0


def test_warc_records_come_back_byte_by_byte(spark):
    pages = spark.createDataFrame([(1, "http://a/", "p" * 999), (2, "http://b/", "p" * 999)], "page_id bigint, url string, html string")
    path = warc.new_archive_path(spark)
    warc.write_archive(pages, path)
    sha1 = warc.sha1_base32(b"p" * 999)
    expected = {warc.record_head(2, "http://b/", sha1, 999, None, False) + b"p" * 999 + b"\r\n\r\n", warc.record_head(1, "http://a/", sha1, 999, 2, True) + b"\r\n\r\n"}
    assert {bytes(r["record"]) for r in warc.reconstruct(spark, path).collect()} == expected


def test_bpe(rows, none):
    path = tokenizer_path("word_bpe_49k.json")
    out = {r["doc_id"]: r for r in bpe_stream.bpe_digests(rows, path).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert (out[1]["n_tokens"], out[1]["ids_sha256"], out[2]["decoded_sha256"]) == (0, empty, empty)
    assert out[4]["ids_sha256"] == out[5]["ids_sha256"]
    assert bpe_stream.bpe_digests(rows, path).count() == len(ROWS) and bpe_stream.bpe_digests(none, path).count() == 0
    assert bpe_stream.encode_column(rows.where("doc_id < 4"), path).where("doc_id = 3").first()["tokens"]


def test_license_scan(spark, rows, none):
    out = license_scan.scan(rows, license_templates())
    assert out.count() == len(ROWS) and out.where("n_base > 0 or labels <> '' or score > 0").count() == 0
    assert license_scan.scan(none, license_templates()).count() == 0
    texts = docs(spark, [(1, "CC BY cc\nBY, all RIGHTS reserved"), (2, "by cc"), (3, "General Public License general public LICENSE" + " license" * 50_000),
                         (4, "Licensed under CC BY-NC 4.0"), (5, "the MIT License"), (6, "MIT License")])
    found = {r["doc_id"]: (r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for r in license_scan.scan(texts, license_templates()).collect()}
    assert found == {1: (3, 0, 4, "cc-by,reserved", "cc-by,reserved"), 2: (0, None, None, "", ""), 3: (2, 0, 3, "gpl", "gpl"),
                     4: (1, 2, 2, "cc-by", "cc-by,cc-by-nc"), 5: (0, None, None, "", "mit"), 6: (0, None, None, "", "")}


def test_quality(spark, rows, none):
    out = quality.quality_scores(rows)
    assert out.count() == len(ROWS) and out.where("quality is null or quality < 0 or quality > 1").count() == 0
    assert out.where("doc_id in (4, 5)").select("quality").distinct().count() == 1
    assert quality.quality_scores(none).count() == 0
    kept = quality.keep_good(rows, threshold=0.0)
    assert kept.columns == rows.columns and kept.count() == len(ROWS)
    assert quality.keep_good(none).count() == 0


def test_quality_trains_on_whole_texts(spark, monkeypatch):
    """All features of a sampled text reach the fit, with the values that
    scoring uses; a bound leaves out whole texts."""
    texts = ["A plain sentence stands here. " * 3, " ".join(f"word{i}" for i in range(3000)) + " at the end.", "one two three"]
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows: seen.append(rows))
    frame = docs(spark, list(enumerate(texts)))
    whole = sorted(sorted(zip(*(x.tolist() for x in quality.features(t)))) for t in texts)
    fitted = lambda: sorted(sorted(zip(at.tolist(), value.tolist())) for at, value, _ in seen[-1])
    quality.fit(frame)
    assert fitted() == whole and max(map(len, whole)) > 2500
    quality.fit(frame, sample_features=60)
    assert 0 < len(seen[-1]) < 3 and all(t in whole for t in fitted())


BODY = '<div class="body"><p>{}</p></div>'.format(words(900))


@pytest.mark.parametrize("page, text", [
    (f'<div class="content"><p>Short lead.</p>{BODY}</div>', "Short lead.\n" + words(900)),
    (f'<div class="content">{BODY}<p>He died in 1990.</p></div>', words(900) + "\nHe died in 1990."),
    (f'<div class="remaining"><header><p>Site name</p></header>{BODY}</div>', words(900)),
    (f'<div class="main-wrap"><header>Site</header>{BODY}</div>', words(900)),
    (f'<article><header><h1>Head</h1></header>{BODY}</article>', "Head\n" + words(900)),
    (f'<article>{BODY}<p>So <math><mi>x</mi></math> holds.</p></article>', words(900) + "\nSo x holds."),
    (f'<article>{BODY}<p class="related">A related thought.</p><blockquote class="notice">Take notice</blockquote></article>', words(900) + "\nA related thought.\nTake notice"),
    *[(f'<article>{BODY}<div class="{name}"><p>gone</p></div></article><div id="{name}"><p>gone</p></div>', words(900))
      for name in ("comment-list", "commentlist", "disqus_thread", "ad-slot", "main-menu", "sidebar-left", "site-footer", "cookie-bar", "newsletter-box")],
    *[(f'{BODY}<div class="{name}"><p>kept</p></div>', words(900) + "\nkept") for name in ("no-sidebar", "has-menu", "related-party-note", "header", "adding", "advice", "listing")],
])
def test_html_loses_main_text_only_by_name_or_by_the_host(spark, page, text):
    assert html_extract.main_text(page, None) == text
    pages = spark.createDataFrame([(i, "http://h.com/a", page) for i in range(3)], "page_id bigint, url string, html string")
    assert [r["text"] for r in html_extract.extract_pages(pages).collect()] == [text] * 3


def test_html_votes_decide(spark):
    """Without votes the notice that the whole host repeats is kept."""
    page = '<div class="content"><p>Lead {0}.</p><div class="body"><p>{0} {1}</p></div></div><div class="note"><p>Printed on paper</p></div><div class="own"><p>Only here {0}</p></div>'
    rows = [(i, "http://h.com/a", page.format(i, words(400))) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    text = "Lead {0}.\n{0} {1}\nPrinted on paper\nOnly here {0}"
    alone = {r["page_id"]: r["text"] for r in html_extract.extract_pages(pages, by_host=False).collect()}
    assert alone == {i: text.format(i, words(400)) for i in range(6)}
    voted = {r["page_id"]: r["text"] for r in html_extract.extract_pages(pages).collect()}
    assert voted == {i: text.format(i, words(400)).replace("Printed on paper\n", "") for i in range(6)}


@pytest.mark.parametrize("page", ["<div>" * 8000 + "x" + "</div>" * 8000, "".join(f"<div>t{i}" for i in range(8000)), "<div>" * 8000 + "x</p></b></section>" * 8000])
def test_html_of_deep_nesting(page):
    import time
    began = time.perf_counter()
    assert html_extract.main_text(page, 1, [2])
    html_extract.page_vote(page)
    assert time.perf_counter() - began < 2


def test_quality_does_not_depend_on_partitions(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    twice = df.unionByName(df.limit(50))
    three, seven = (quality.fit(twice.repartition(n), sample_rows=300) for n in (3, 7))
    assert (three == seven).all() and three.any()


def test_licences_by_their_own_notices(spark):
    """Every notice, heading and SPDX line gives its label, alone and inside
    other text; a notice of which the key phrase is cut gives none."""
    from occurrence_lake.llm.license_notices import NOTICES
    rows = [(i, ("word " * (i % 3)) + notice + " and more") for i, (_, _, notice) in enumerate(NOTICES)]
    rows += [(1000, "// SPDX-License-Identifier: Apache-2.0 OR MIT"), (1001, "you may not use this file except in compliance with the License"),
             (1002, "the GNU General Public License version 3"), (1003, "GNU General Public License")]
    found = {r["doc_id"]: r["labels"].split(",") for r in license_scan.scan(docs(spark, rows), license_templates()).collect()}
    assert [NOTICES[i][0] for i in range(len(NOTICES)) if NOTICES[i][0] not in found[i]] == []
    assert found[1000] == ["apache-2.0"] and found[1001] == [""] and found[1002] == ["gpl", "gpl-3.0"] and found[1003] == ["gpl"]
    assert all(template.key in template.words for template in license_templates())
