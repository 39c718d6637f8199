"""Licence scan: canonical digests of entire texts, looked up among those of known licences."""

from __future__ import annotations

import string
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.llm.licence_texts import LICENCES

_EDGE = r"[ \t\r*#/;!-]*+"
_SIGN = r"(?:copyright[ \t]*+(?:\(c\)|©|\d{4}|[\[{<(]y)|\(c\)|©)"
#: Words after which "copyright" speaks of the terms and not of an owner.
TERMS = "notices?|holders?|owners?|laws?|licen[sc]es?|interests?|statements?|permissions?|disclaimers?|and|or|in|of|on|is|to"
TITLE = "the|mit|expat|x11|isc|0?bsd|zero|zlib|[0-9]|new|simplified|revised|modified|clause|licen[sc]e|unlicense|all rights reserved"
#: Lines that name owners and years say nothing about the terms. They stand before the terms, where only
#: titles may precede them, or after the end; a line of the terms may begin with "copyright" too.
OWNER_BEFORE = rf"\G((?:[\s*#/;!.,:()\"'-]*+(?:{TITLE})(?![a-z0-9]))*+(?:[ \t\r\f\x0B.*#/;!)-]*+\n)++){_EDGE}(?:{_SIGN}|copyright[ \t]++(?!(?:{TERMS})(?![a-z])))[^\n]*+"
OWNER_AFTER = rf"\A((?s:.*)\n(?!{_EDGE}(?:\n|\z|{_SIGN}))[^\n]*+)(?s:.*+)\z"
#: ASCII and Latin-1 signs and white space, dashes and curly quotes: all one space.
SIGNS = r"[\x{1}-\x{2f}\x{3a}-\x{60}\x{7b}-\x{bf}\x{2010}-\x{201f}]+"
#: Spellings that count as equal, as they stand once signs are spaces. Fixed values.
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("sub licensing", "sublicensing"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("recognise", "recognize"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("copyright owner", "copyright holder"),
    ("http www", "https www"),
    ("per cent", "percent"),
)
#: The place of the owner in the appendix of Apache-2.0.
APACHE_OWNER = r"\A(?>(.*? third party archives )copyright )(?>.*?(?= licensed under the apache license version 2 0 ))"


def canonical(text: Column) -> Column:
    """A to Z lower-cased, owner lines before and after the terms gone, signs and white space one space, spellings levelled.

    "All rights reserved" goes wherever it stands, once white space is levelled. So where the lines of the
    terms are wrapped makes no difference.
    """
    text = F.concat(F.lit("\n"), F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase))
    text = F.regexp_replace(text, OWNER_BEFORE, "$1")
    text = F.regexp_replace(text, OWNER_AFTER, "$1")
    text = F.concat(F.regexp_replace(text, SIGNS, " "), F.lit(" "))
    for other, one in SPELLINGS:
        text = F.replace(text, F.lit(other), F.lit(one))
    text = F.regexp_replace(text, APACHE_OWNER, "$1")
    return F.trim(F.replace(text, F.lit(" all rights reserved "), F.lit(" ")))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_texts() -> list[tuple[str, str]]:
    """``(license_id, text)``: short licences with and without titles, and the files of ``known/``.

    A file is named by its licence, up to a plus sign. Where it has an appendix after the end of its
    terms, the terms alone count too.
    """
    rows = []
    for name, title, body in LICENCES:
        titles = (title, f"The {title.removeprefix('The ')}", f"{title} ({name})", f"The {title} ({name})")
        rows += [(name, body)] + [(name, f"{t}\n\n{body}") for t in titles]
    for path in sorted((Path(__file__).parent / "known").glob("*.txt")):
        name, text = path.stem.split("+")[0], path.read_text(encoding="utf-8")
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        rows += [(name, text)] + ([(name, terms), (name, terms + end)] if end else [])
    return rows


def known_licences(spark: SparkSession) -> DataFrame:
    """``license_id, text`` of the known licences."""
    return spark.createDataFrame(known_texts(), "license_id string, text string")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, license_digest, license_id``: the licence that each entire text is, or null.

    Texts match where their canonical digests are equal, so a text that only mentions or contains a
    licence has none. If known licences share a digest the name that sorts first is given; known texts
    that are canonically empty match nothing. Null texts count as empty. Null and repeated doc_ids are
    rows like others; other columns are ignored; an empty table gives no rows. The join is left to
    Spark's own size checks: a small list of licences is broadcast, a large one shuffled on the digest,
    where adaptive execution splits a digest that very many documents share.
    """
    empty = digest(F.lit(""))
    listed = known.select(digest(F.col("text")).alias("license_digest"), "license_id").filter(F.col("license_digest") != empty)
    listed = listed.groupBy("license_digest").agg(F.min("license_id").alias("license_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text").cast("string")).alias("license_digest"))
    return texts.join(listed, "license_digest", "left").select("doc_id", "license_digest", "license_id")
