import json

import pytest

from occurrence_lake.operators import names
from occurrence_lake.plans.driver_queries import QUERIES
from occurrence_lake.sources import fixtures
from occurrence_lake.sources.replies import MalformedReplies, checked_replies, malformed_replies, parse_species_replies, rejected_replies

from conftest import SF_SMALL


def test_first_name_per_language(spark):
    recs = spark.createDataFrame([
        (1, 1, "fra", None), (1, 2, "fra", ""), (1, 3, "fra", "b"),
        (1, 4, "deu", "Gams"), (1, 0, "deu", None), (1, 5, "eng", "Chamois"), (1, 6, "eng", "Other"),
        (1, 7, "spa", "Rebeco"),
        (2, 1, "eng", None),
    ], "taxon_key long, seq long, language string, name string")
    got = {r.taxon_key: r for r in names.first_name_per_language(recs).collect()}
    assert got[1].vernacular_name_fra == ""          # '' is a name, NULL is not
    assert got[1].vernacular_name_deu == "Gams"
    assert got[1].vernacular_name_eng == "Chamois"
    assert (got[2].vernacular_name_deu, got[2].vernacular_name_eng, got[2].vernacular_name_fra) == (None, None, None)


def test_vernacular_keeps_keys_without_names(spark):
    keys = spark.createDataFrame([(1,), (9,)], "taxon_key long")
    recs = spark.createDataFrame([(1, 1, "eng", "Ibex")], "taxon_key long, seq long, language string, name string")
    got = {r.taxon_key: r for r in names.vernacular_names(keys, recs).collect()}
    assert got[1].vernacular_name_eng == "Ibex"
    assert got[9].vernacular_name_eng is None and set(got) == {1, 9}
    assert dict(names.vernacular_names(keys, recs).dtypes)["taxon_key"] == "int"


def test_json_replies(spark):
    replies = spark.createDataFrame([
        (1, 0, '{"results":[{"language":"fra","vernacularName":null},{"language":"fra","vernacularName":"Chamois"}]}'),
        (1, 1, '{"results":[{"language":"deu","vernacularName":"Gämse"}]}'),
        (2, 0, "{}"),
        (3, 0, '{"results": [{"langu'),
        (4, 0, '{"results": []}'),
    ], "taxon_key long, page long, body string")
    seen = malformed_replies(replies).first()
    assert (seen.replies, seen.malformed) == (5, 1)
    parsed = parse_species_replies(replies)
    got = {r.taxon_key: r for r in names.first_name_per_language(parsed, order_by=("page", "pos")).collect()}
    assert got[1].vernacular_name_fra == "Chamois" and got[1].vernacular_name_deu == "Gämse"
    for k in (2, 3, 4):
        assert (got[k].vernacular_name_deu, got[k].vernacular_name_eng, got[k].vernacular_name_fra) == (None,) * 3


def test_scientific_names_semi_join(spark):
    keys = spark.createDataFrame([(1,), (None,)], "taxon_key long")
    raw = spark.createDataFrame([(1, "A"), (1, "A"), (1, "B"), (2, "C"), (None, "D")],
                                "taxon_key long, scientific_name string")
    got = sorted((r.taxon_key, r.scientific_name) for r in names.scientific_names(keys, raw).collect())
    assert got == [(1, "A"), (1, "B")]


def test_species_names_and_missing(spark):
    sci = spark.createDataFrame([(1, "A"), (2, "B")], "taxon_key long, scientific_name string")
    vern = spark.createDataFrame([(1, None, None, None), (2, "x", None, None), (3, "y", None, None)],
                                 "taxon_key int, vernacular_name_deu string, vernacular_name_eng string, "
                                 "vernacular_name_fra string")
    assert sorted(r.taxon_key for r in names.species_names(sci, vern).collect()) == [1, 2]
    m = names.missing_vernacular(vern).first()
    assert (m.missing_vernacular, m.species) == (1, 3)


GOOD = '{"results":[{"language":"fra","vernacularName":"a]}, b"}]}'
BODIES = [GOOD, " \n" + GOOD + "\t", "{}", '{"results":[]}', '{"other":{"deep":[1,2,{"x":null}]},"results":[]}', '{"n":NaN}',
          GOOD + "}", GOOD + "]", GOOD + ",", GOOD + GOOD, GOOD + "," + GOOD, GOOD + ',"y":1', GOOD + " x", GOOD + "] [", GOOD + '},"y":{"a":1', "x" + GOOD,
          GOOD[:20], GOOD[:-1], "", " ", "null", "7", '"s"', "[" + GOOD + "]", "{'results':[]}", "{results:[]}", '{"results":[],}', '{"results":[1,]}', '{"a":01}', '{"a":"\t"}']
WRONG_TYPES = ['{"results":"x"}', '{"results":[7]}', '{"results":{"language":[]}}']


def test_malformed_is_what_a_strict_parser_rejects(spark):
    def strict(body):
        try:
            return isinstance(json.loads(body), dict)
        except ValueError:
            return False

    rows = [(i, 0, b) for i, b in enumerate([*BODIES, *WRONG_TYPES, None])]
    replies = spark.createDataFrame(rows, "taxon_key long, page long, body string")
    bad = {r.taxon_key: r.reason for r in rejected_replies(replies).collect()}
    assert {BODIES[i] for i in range(len(BODIES)) if i not in bad} == {b for b in BODIES if strict(b)}
    assert all(bad[len(BODIES) + i] == "not of the reply's shape" for i in range(len(WRONG_TYPES))) and bad[len(rows) - 1] == "no body"
    assert tuple(malformed_replies(replies).first()) == (len(rows), len(bad))


def test_malformed_replies_end_the_run_or_are_written(spark, workdir):
    whole = fixtures.species_replies_from_records(fixtures.vernacular_records(spark, SF_SMALL))
    assert checked_replies(whole).count() == whole.count()
    cut = whole.selectExpr("taxon_key", "page", "CASE WHEN taxon_key % 7 = 0 THEN left(body, 20) ELSE body END AS body")
    with pytest.raises(MalformedReplies):
        checked_replies(cut)
    good = checked_replies(cut, f"{workdir}/rejected")
    assert good.where("taxon_key % 7 = 0").count() == 0 and good.count() + spark.read.parquet(f"{workdir}/rejected").count() == whole.count()


def test_the_query_counts_replies_that_are_malformed_at_their_end(spark, workdir):
    """Keys 0, 3 and 21 (key = 3 * (doc_id % 160)), two replies each; no body is shortened."""
    rows = [(d, "en", "a" * 200) for d in (0, 1, 7, 160, 161, 167)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string").write.parquet(f"{workdir}/documents.parquet")
    assert tuple(QUERIES["malformed_replies"](spark, workdir).first()) == (6, 4)
    replies = fixtures.species_replies_from_records(fixtures.vernacular_records(spark, workdir))
    asked = replies.select("taxon_key", "body", fixtures.with_text_behind("taxon_key", "body").alias("asked")).collect()
    assert all(r.asked == (r.body + "}" if r.taxon_key % 7 == 0 else r.body) for r in asked)
