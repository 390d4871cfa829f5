"""EXP-9: vernacular names from species-API replies (JSON text).

The reference reads a reply with a strict JSON parser and ends at the first
one that is none.  Spark's parser is laxer: it stops where the object ends,
so text behind it goes unseen.  A reply is therefore *well formed* only if it
also parses whole as the one element of an array and as the one member of an
object (text behind it breaks one of the two), with single quotes and
unquoted names refused.  Replies that are not are counted, can be written
with the reason, or end the run (``checked_replies``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from occurrence_lake.schema import SPECIES_REPLY_SCHEMA


# Single quotes are no JSON.
_STRICT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}


def _parsed(replies: DataFrame) -> DataFrame:
    schema = T.StructType([*SPECIES_REPLY_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    r = F.from_json("body", schema,
                    _STRICT)
    return replies.select("taxon_key", "page", "body", r.alias("r"))


def parse_species_replies(replies: DataFrame) -> DataFrame:
    """Reply JSON -> one row per result, ``(taxon_key, page, pos, language, name)``.

    A missing ``results`` member, ``{}`` or an unparsable body yields no
    result row; the taxon is still kept (with NULL language) so that a key
    looked up without a hit survives with three NULL names.
    """
    return (_parsed(replies)
            .select("taxon_key", "page", F.posexplode_outer("r.results").alias("pos", "item"))
            .select("taxon_key", "page", "pos",
                    F.col("item.language").alias("language"),
                    F.col("item.vernacularName").alias("name")))


def _whole(body: str):
    """Whether a body is one JSON object and nothing else."""
    text = F.col(body)
    element = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", _STRICT)
    member = F.from_json(F.concat(F.lit('{"x":'), text, F.lit("}")), "x string, _corrupt string", _STRICT)
    return text.rlike(r"^[ \t\r\n]*\{") & (F.size(element) == 1) & F.element_at(element, 1).isNotNull() & member["_corrupt"].isNull()


def _reason():
    """Why a reply (``body``, parsed as ``r``) is malformed; null if it is not."""
    return (F.when(F.col("body").isNull(), "no body")
            .when(~F.coalesce(_whole("body"), F.lit(False)), "no JSON object, or text beside it")
            .when(F.col("r._corrupt").isNotNull(), "not of the reply's shape"))


def rejected_replies(replies: DataFrame) -> DataFrame:
    """The malformed replies with their ``reason``."""
    return _parsed(replies).select("taxon_key", "page", "body", _reason().alias("reason")).where(F.col("reason").isNotNull())


def malformed_replies(replies: DataFrame) -> DataFrame:
    """One row: ``replies``, ``malformed`` (a body that is not one JSON
    object of the reply's shape; a NULL body is malformed too)."""
    return _parsed(replies).agg(F.count(F.lit(1)).alias("replies"), F.count_if(_reason().isNotNull()).alias("malformed"))


class MalformedReplies(ValueError):
    pass


def checked_replies(replies: DataFrame, rejected: str | None = None) -> DataFrame:
    """The well-formed replies.  Malformed ones raise, as in the reference,
    or go as a table to the path ``rejected``."""
    if rejected is None:
        seen = malformed_replies(replies).first()
        if seen["malformed"]:
            raise MalformedReplies(f"{seen['malformed']} of {seen['replies']} replies are malformed")
        return replies
    rejected_replies(replies).write.mode("overwrite").parquet(rejected)
    return _parsed(replies).where(_reason().isNull()).select("taxon_key", "page", "body")
