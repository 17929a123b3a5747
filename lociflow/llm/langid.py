"""Language identification by compression (operator 3).

For each language, whole training texts chosen by a hash of their ids form a raw-content
zstandard dictionary.  A text is normalised (lower case, letters only), cut into chunks so
that the dictionary and not the text's own past decides, and every chunk is encoded once
per language; the language with the smallest sum of encoded bytes is chosen.  The decision
is marked as rejected when the second language is nearer than ``MIN_MARGIN``.

Bounded sample: ``DICT_BYTES`` of normalised text per language, at most ``PIECE_BYTES`` of one text so that no long
one fills a dictionary alone, taken from about ``SAMPLE_DOCS`` training rows of each language at
most (documented parameters of the fit; the prediction reads whole texts of all rows).

Edge cases: null, empty and letterless texts are ``und`` with score 0; equal sizes go to the
alphabetically first language and are rejected; with no training rows at all everything is
``und``; very long texts cost time in proportion; repeated rows get equal results.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociflow.llm.common import small_batches

DICT_BYTES, PIECE_BYTES, SAMPLE_DOCS = 64 * 1024, 8 * 1024, 300
#: Characters of a chunk, compression level, and the relative margin under which a decision is rejected.
CHUNK, LEVEL, MIN_MARGIN = 16384, 7, 0.004
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalise(text: str | None) -> str:
    out = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return out if any(c.isalpha() for c in out) else ""


def fit_dictionaries(training: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> dict[str, bytes]:
    """Raw dictionary content per language from ``training`` (rows with a null language or text are left out)."""
    rows = training.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return {}
    part = F.lit(0.0)
    for name, n in counts.items():
        part = F.when(F.col(lang) == name, min(1.0, SAMPLE_DOCS / n)).otherwise(part)
    draw = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit("langid")), F.lit(1 << 30)) / float(1 << 30)
    sizes = F.length(F.col(text))
    picked = rows.where(draw < part).select(F.col(lang).alias("l"), F.col(text).alias("t"), draw.alias("d"), sizes.alias("n"))
    # the driver takes whole texts in draw order up to DICT_BYTES per language
    taken: dict[str, list[bytes]] = {}
    held: dict[str, int] = {}
    for r in picked.sort("d", "l", "n").toLocalIterator(prefetchPartitions=False):
        if held.get(r.l, 0) < DICT_BYTES:
            piece = normalise(r.t).encode()[: min(PIECE_BYTES, DICT_BYTES - held.get(r.l, 0))]
            taken.setdefault(r.l, []).append(piece)
            held[r.l] = held.get(r.l, 0) + len(piece) + 1
    return {name: b" ".join(pieces)[:DICT_BYTES] for name, pieces in sorted(taken.items())}


class _Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries)
        self.encoders = []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.encoders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False).compress)

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        clean = normalise(text)
        if not clean or not self.names:
            return UNKNOWN, 0.0, True
        chunks = [clean[i : i + CHUNK].encode("utf-8", "surrogatepass") for i in range(0, len(clean), CHUNK)]
        sizes = [sum(len(encode(c)) for c in chunks) for encode in self.encoders]
        best, *rest = sorted(zip(sizes, self.names, strict=True))
        if not rest:
            return best[1], 1.0, False
        margin = (rest[0][0] - best[0]) / rest[0][0]
        return best[1], 1.0 - math.exp(-20.0 * margin), margin < MIN_MARGIN


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected; clashing columns are replaced."""
    small_batches(docs.sparkSession)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("lang_pred", "score", "rejected")])
    names = docs.columns

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = _Classifier(dictionaries)
        for batch in batches:
            found = [classifier(t) for t in batch.column(names.index(text)).to_pylist()]
            lang, score, rejected = ([x[k] for x in found] for k in range(3))
            added = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*names, "lang_pred", "score", "rejected"])

    added_fields = T.StructType().add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    schema = T.StructType([*docs.schema.fields, *added_fields.fields])
    return docs.mapInArrow(classify, schema)
