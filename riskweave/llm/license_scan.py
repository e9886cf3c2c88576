"""Licence scan by canonical digests.

A text is brought to one form - letters A-Z in lower case, copyright lines left
out, everything but letters and digits taken as one separator, equivalent
spellings made the same - and its SHA-256 is looked up, by a hash join, among
the digests of known licences. Entire texts are compared: the document as a
whole, and each of its lines, since notices stand on lines of their own.

Defined cases: null counts as empty; a text or line with nothing left has no
digest and matches nothing; a digest known under several names matches each
(listed in order); texts of any length are read whole; rows that repeat an id
share that id's lines; a null id is an id like any other; an empty table gives an
empty result. Only the id and the text column are read, so other columns may
have any name.

The licence of a whole text is also looked up without its lines of copyright
statement ('All rights reserved.', 'Copyright The X Authors'), which
``text_digest`` keeps.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.license_texts import KNOWN, WHOLE
from riskweave.llm.staging import BROADCAST_ROWS, Staged

#: Equivalent spellings, as license comparison guidelines list them (fixed values).
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment",
    "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license",
    "licences": "licenses", "licenced": "licensed", "maximise": "maximize", "modelled": "modeled", "modelling": "modeling",
    "offence": "offense", "optimise": "optimize", "organisation": "organization", "organise": "organize", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling", "utilisation": "utilization",
    "whilst": "while", "wilful": "willful", "noncommercial": "non commercial", "sublicence": "sublicense", "https": "http",
}

#: A line that names a copyright holder, and what separates words; both also serve in SQL.
COPYRIGHT_LINE = r"(?m)^[^a-z0-9©\n]*(copyright[ \t]*(\(c\)|©|[0-9]{4}|\[|<)|\(c\)[ \t]*(copyright|[0-9]{4})|©)[^\n]*$"
SEPARATOR = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = str.maketrans(_UPPER, _UPPER.lower())
_SEPARATOR = re.compile(SEPARATOR)
_SPELLING = re.compile(r"(?<![^ ])(?:" + "|".join(sorted(SPELLINGS, key=len, reverse=True)) + r")(?![^ ])")

#: Further lines of copyright statement: no licence's own words stand on a line like these.
STATEMENT_LINE = (
    r"(?m)^[^A-Za-z0-9©\n]*(?:Copyright[ \t]*:[^\n]*|Copyright[ \t]+(?:[Tt]he|[Bb]y)[ \t]+[A-Z0-9][^\n]*|[Aa][Ll][Ll][ \t]+[Rr][Ii][Gg][Hh][Tt][Ss][ \t]+[Rr][Ee][Ss][Ee][Rr][Vv][Ee][Dd])[^A-Za-z0-9\n]*$"
)
_COPYRIGHT, _STATEMENT = re.compile(COPYRIGHT_LINE), re.compile(STATEMENT_LINE)


def canonical(text: str) -> str:
    """The text in its canonical form; empty if nothing is left."""
    text = text.translate(_LOWERED)
    if "copyright" in text or "(c)" in text or "©" in text:
        text = _COPYRIGHT.sub("", text)
    words = _SEPARATOR.sub(" ", text).strip(" ")
    return _SPELLING.sub(lambda m: SPELLINGS[m[0]], words)


def digest(text: str) -> str | None:
    text = canonical(text)
    return hashlib.sha256(text.encode()).hexdigest() if text else None


def bare_digest(text: str) -> str | None:
    """Digest without all lines of copyright statement; None if there are none besides those that ``digest`` leaves out."""
    bare, lines = _STATEMENT.subn("", text)
    return digest(bare) if lines else None


#: Places of a text's own forms beside its lines, which count from 1.
WHOLE_TEXT, BARE_TEXT = 0, -1


def forms(text: str) -> list[tuple[int, str | None]]:
    """(place, digest) of the whole text, of its bare form if that differs, and of each line with something left."""
    bare = bare_digest(text)
    lines = ((n, digest(line)) for n, line in enumerate(text.split("\n"), 1))
    return [(WHOLE_TEXT, digest(text)), *([(BARE_TEXT, bare)] if bare else []), *((n, d) for n, d in lines if d)]


_FORMS = T.ArrayType(T.StructType([T.StructField("place", T.IntegerType()), T.StructField("digest", T.StringType())]))


@F.arrow_udf(_FORMS)
def text_forms(text: pa.Array) -> pa.Array:
    """text -> its places and digests."""
    listed = [forms(own.as_py() or "") for own in text]
    kind = pa.list_(pa.struct([("place", pa.int32()), ("digest", pa.string())]))
    return pa.array([[{"place": n, "digest": d} for n, d in own] for own in listed], kind)


def known_digests(spark: SparkSession, known: Iterable[tuple[str, str]] = KNOWN, digests: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """(digest, license): one row per known digest, names joined where several share one; ``digests`` are (license, digest)."""
    rows = [(digest(text), name) for name, text in known] + [(own, name) for name, own in digests]
    table = spark.createDataFrame([r for r in rows if r[0]], "digest string, license string")
    return table.groupBy("digest").agg(F.array_join(F.sort_array(F.collect_set("license")), " / ").alias("license"))


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, text_digest, license (of the whole text), n_notices, notices (line:license, comma-joined).

    known: (digest, license), by default the texts that come with the module.
    """
    known = known if known is not None else known_digests(docs.sparkSession, digests=WHOLE)
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    staged = Staged(docs.sparkSession, "licences")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    found = rows.select("id", "row", F.inline(text_forms("text")))
    # What goes on is a row for each document and one for each hit.
    found = staged.write(found.join(known, "digest", "left").where((F.col("place") == WHOLE_TEXT) | F.col("license").isNotNull()), "forms")
    hits = found.where(F.col("place") > 0).groupBy("id").agg(F.sort_array(F.collect_set(F.struct("place", "license"))).alias("found"))
    notices = hits.select(
        F.col("id").alias("hit_id"),
        F.size("found").cast("long").alias("n_notices"),
        F.array_join(F.transform("found", lambda f: F.concat_ws(":", f["place"].cast("string"), f["license"])), ",").alias("notices"),
    )
    bare = found.where(F.col("place") == BARE_TEXT).select("row", F.col("license").alias("bare_license"))
    wholes = found.where(F.col("place") == WHOLE_TEXT).join(bare, "row", "left")
    joined = wholes.join(notices, F.col("id").eqNullSafe(F.col("hit_id")), "left")
    return joined.select(
        F.col("id").alias(id_col), F.col("digest").alias("text_digest"), F.coalesce("license", "bare_license").alias("license"),
        F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices"),
    )
